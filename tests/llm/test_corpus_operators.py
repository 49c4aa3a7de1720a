"""The corpus operators against brute force on small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tributary.llm import blocks, decontaminate, encoding, language, lexical, lm, ngram_join, packing, quality, queries, shards, substrings, text, token_files, tries, urls
from tributary.llm.graph import components, least_labels
from tributary.llm.skew import join_counted
from tributary.workspace import new_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard string, block string, part int"
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(20_000))
PASSAGE = " ".join(f"passage{i}" for i in range(60))
TEXTS = [
    None,
    "",
    " \n\t",
    "one",
    "one two three",
    "One TWO three",
    "a b c d e f g h",
    "a b c d e f g h",
    "a b c d e f g h i",
    f"start here {PASSAGE} and the end",
    f"another {PASSAGE} text that goes on",
    PASSAGE,
    f"{PASSAGE} {PASSAGE}",
    LONG,
    LONG,
    LONG.replace("w5x", "W5X"),
    "same line\nsame line\n\nother *** ### line\n",
    "the cat sat on the mat " * 30,
    "žluťoučký kůň 漢字 語\u00a0x \x1c y",
    "12 34 !!",
]


def table(spark, texts=TEXTS, ids=None):
    ids = ids or list(range(len(texts)))
    rows = [(i, t, "en" if i is not None and i % 2 else "fr", "s", 0 if t is None else len(t), "x", "y", 1) for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark).repartition(3).cache()


@pytest.fixture(scope="module")
def odd(spark):
    """Null and repeated ids and rows."""
    return table(spark, ["a b c d e f", "a b c d e f", None, "x y", PASSAGE, PASSAGE, PASSAGE], [7, 7, None, None, 3, None, 3])


def words(t, lower=False):
    t = t or ""
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t) if lower else t)


# The text kernel.


def test_words_and_hashes():
    batch = text.Words(pa.array(TEXTS, pa.string()))
    assert [[w.decode() for w in batch.strings(d)] for d in range(len(TEXTS))] == [words(t) for t in TEXTS]
    hashes = batch.hashes()
    flat = [w for t in TEXTS for w in words(t)]
    assert len(set(hashes.tolist())) == len(set(flat)) and len({(h, w) for h, w in zip(hashes.tolist(), flat, strict=True)}) == len(set(flat))


def test_distinct_is_unique():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 5, 1000, 50_000):
        for top in (1, 3, 1000, 2**44, 2**63):
            given = rng.integers(0, top, n, dtype=np.uint64)
            for own, other in zip(text.distinct(given), np.unique(given, return_inverse=True), strict=True):
                assert (own == other).all()


def test_slices_hold_all_rows():
    batch = pa.RecordBatch.from_pydict({"text": pa.array([*TEXTS, None])})
    parts = list(text.sliced(batch, most=1000))
    assert sum(p.num_rows for p in parts) == len(TEXTS) + 1 and len(parts) > 3
    assert pa.Table.from_batches(parts).column("text").to_pylist() == [*TEXTS, None]


# 1: sharding.


@pytest.mark.parametrize("bucket_bytes", [200, 1 << 20])
def test_shards(docs, bucket_bytes):
    rows = shards.shuffle_into_shards(docs, 3, bucket_bytes=bucket_bytes).collect()
    assert sorted((r.doc_id, r.text or "") for r in rows) == sorted((i, t or "") for i, t in enumerate(TEXTS))
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    assert sorted(by) == [0, 1, 2] and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    again = shards.shuffle_into_shards(docs, 3, bucket_bytes=bucket_bytes).collect()
    assert {(r.doc_id, r.shard) for r in rows} == {(r.doc_id, r.shard) for r in again} or bucket_bytes == 1 << 20


def test_shards_of_odd_and_empty_tables(spark, odd, tmp_path):
    digest = shards.shard_digest(shards.write_shards(shards.shuffle_into_shards(odd, 24), str(tmp_path / "s"))).collect()
    assert len(digest) == 7 and len({(r.shard, r.slot) for r in digest}) == 7
    assert {(r.size, r.text_crc32) for r in digest if r.doc_id == 7} == {(19, zlib.crc32(b"a b c d e f"))}
    assert shards.shuffle_into_shards(table(spark, []), 24).count() == 0


def test_shards_with_other_columns(spark):
    names = ["_bucket", "_at", "_record", "_records", "_base", "_n", "shard", "slot", "a.b"]
    given = spark.createDataFrame([(n % 3, f"text {n % 4}", *[str(n)] * len(names)) for n in range(40)], ", ".join(["doc_id long, text string", *(f"`{n}` string" for n in names)]))
    found = shards.shuffle_into_shards(given, 4, bucket_bytes=60).collect()
    assert sorted((r.doc_id, r.text, r["_at"], r["a.b"]) for r in found) == sorted((n % 3, f"text {n % 4}", str(n), str(n)) for n in range(40))
    assert sorted((r.shard, r.slot) for r in found) == [(s, k) for s in range(4) for k in range(10)]


def test_repeated_rows_are_spread(spark):
    """A row that is a third of all rows is in many blocks and buckets, and all results stay whole."""
    texts = [f"some text number {n} with words" for n in range(600)] + ["the same words again and again"] * 300
    given = table(spark, texts, [*range(600), *[7] * 150, *[None] * 150]).repartition(4)
    blocked, n = blocks.into_blocks(given, "lang", block_bytes=5000)
    sizes = {r.block: r["count"] for r in blocked.groupBy("block").count().collect()}
    assert sum(sizes.values()) == 900 and n > 10 and max(sizes.values()) < 4 * 900 / n
    bare, _ = blocks.into_blocks(given, block_bytes=1 << 20)
    assert bare.count() == 900
    found = shards.shuffle_into_shards(given, 5, bucket_bytes=3000).collect()
    assert Counter((r.doc_id, r.text) for r in found) == Counter(zip([*range(600), *[7] * 150, *[None] * 150], texts, strict=True))
    assert len({(r.shard, r.slot) for r in found}) == 900
    assert sum(r.component_id == 7 for r in ngram_join.join_similar(given, block_bytes=5000).where("n_shingles = 2").collect()) == 301
    rows = lm.score(given, block_bytes=5000).collect()
    wanted = brute_scores(texts, range(900), [False] * 900)
    assert sorted(r.score for r in rows) == pytest.approx(sorted(w[6] for w in wanted))


def test_repeated_rows_in_token_files(spark, tmp_path):
    path, folder = public_tokenizers.path("byte_bpe_50k.json"), f"file://{tmp_path}/t"
    given = table(spark, ["the same words again"] * 400 + ["other"] * 3, [5] * 400 + [4, 6, None]).repartition(4)
    manifest = token_files.write_token_files(given, folder, path, 2, part_bytes=3000)
    assert manifest.count() > 4 and manifest.agg(F.max("n_docs")).first()[0] < 250
    rows = sorted(token_files.read_token_files(manifest, folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, 4, *[5] * 400, 6]
    at = 0
    for r in rows:
        assert r.start == at
        at += r.n_tokens


# 2: n-gram join.


def brute_components(texts, ids, k=5, percent=80):
    sets = []
    for t in texts:
        w = words(t, lower=True)
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    label = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * len(sets[a] | sets[b]):
                label = [label[a] if x == label[b] else x for x in label]
    out = []
    for a in range(len(texts)):
        members = [ids[b] for b in range(len(texts)) if label[b] == label[a] and ids[b] is not None]
        out.append((ids[a], len(sets[a]), min(members) if members and sets[a] else ids[a]))
    return sorted(out, key=str)


@pytest.mark.parametrize("how", [{}, {"block_sets": 2, "block_items": 3000, "pivots": 1}])
def test_ngram_join(spark, docs, how):
    found = sorted((tuple(r) for r in ngram_join.join_similar(docs, **how).collect()), key=str)
    assert found == brute_components(TEXTS, list(range(len(TEXTS))))


def test_ngram_join_of_chains_and_odd_tables(spark, odd):
    base = [f"t{i}" for i in range(60)]
    chain = [" ".join(base[: 60 - 4 * n] + [f"n{n}x{i}" for i in range(4 * n)]) for n in range(6)]
    ids = [50 - n for n in range(6)]
    found = sorted((tuple(r) for r in ngram_join.join_similar(table(spark, chain, ids)).collect()), key=str)
    assert found == brute_components(chain, ids)
    rows = [tuple(r) for r in ngram_join.join_similar(odd).collect()]
    assert sorted(rows, key=str) == sorted([(7, 2, 7), (7, 2, 7), (None, 0, None), (None, 1, None), (3, 56, 3), (3, 56, 3), (None, 56, 3)], key=str)
    assert ngram_join.join_similar(table(spark, [])).count() == 0


@pytest.mark.parametrize("ids", [lambda n: None, lambda n: n % 3, lambda n: n])
@pytest.mark.parametrize("how", [{}, {"block_sets": 8, "block_items": 2000, "pivots": 2}])
def test_ngram_join_fetches_one_text_for_each_member(spark, monkeypatch, ids, how):
    base = [[f"g{g}t{i}" for i in range(40)] for g in range(2)]
    texts = [" ".join([*base[n % 2][: 38 - n % 5], f"n{n}"]) for n in range(24)] * 2
    rows = [ids(n % 24) for n in range(48)]
    fetched = []

    def joined(k, percent):
        join = real(k, percent)

        def count(rows):
            out = join(rows)
            members = rows.num_rows
            return pa.table({"a": [*out.column("a").to_pylist(), b"rows"], "b": [*out.column("b").to_pylist(), str(members).encode()]}, schema=pa.schema([("a", pa.binary()), ("b", pa.binary())]))

        return count

    real, trees = ngram_join._joined, ngram_join._trees

    def counted(docs, members, *args):
        out = trees(docs, members, *args).cache()
        fetched.append((members.count(), sum(int(r.b) for r in out.where("a = X'726F7773'").collect())))
        return out.where("a <> X'726F7773'")

    monkeypatch.setattr(ngram_join, "_joined", joined)
    monkeypatch.setattr(ngram_join, "_trees", counted)
    found = sorted((tuple(r) for r in ngram_join.join_similar(table(spark, texts, rows), **how).collect()), key=str)
    assert found == brute_components(texts, rows)
    assert fetched and all(members == got for members, got in fetched)


@pytest.mark.parametrize("how", [{}, {"block_bytes": 4000}, {"block_bytes": 1500, "most_blocks": 3, "part_items": 100}])
def test_ngram_join_files_a_hot_item_once_for_a_block(spark, monkeypatch, tmp_path, how):
    rng = np.random.default_rng(3)
    base = [f"t{i}" for i in range(60)]
    texts = [" ".join([*base[: 58 - n % 7], f"n{n}"]) for n in range(60)] + [" ".join(f"o{x}" for x in rng.integers(0, 30, 12)) for _ in range(20)]
    texts += [" ".join(base[: 60 - 4 * n]) for n in range(12)]
    real = ngram_join._candidates

    def candidates(percent):
        gather = real(percent)

        def noted(rows):
            times = Counter(np.concatenate([ngram_join.unpacked_keys(x, "<u8") for x in rows.column("items").to_pylist()]).tolist())
            with (tmp_path / f"{rows.column('part')[0]}").open("w") as f:
                f.write(str(max(times.values(), default=0)))
            return gather(rows)

        return noted

    monkeypatch.setattr(ngram_join, "_candidates", candidates)
    given = table(spark, texts)
    found = sorted((tuple(r) for r in ngram_join.join_similar(given, **how).collect()), key=str)
    assert found == brute_components(texts, list(range(len(texts))))
    blocks = ngram_join.into_blocks(given, block_bytes=how.get("block_bytes", 4 << 20))[1]
    runs = 3 * (math.ceil(blocks / how["most_blocks"]) if "most_blocks" in how else blocks)
    assert 1 <= max(int(f.read_text()) for f in tmp_path.iterdir()) <= runs


def test_runs_of_runs_are_those_of_the_sets():
    rng = np.random.default_rng(5)
    for trial in range(200):
        n, percent = int(rng.integers(0, 40)), int(rng.choice([50, 80, 100]))
        item, sizes = rng.integers(0, 3, n).astype(np.uint64), rng.integers(1, 60, n)
        label = np.arange(n)
        for x in range(3):
            own = sorted(np.flatnonzero(item == x), key=lambda i: sizes[i])
            for a, b in zip(own, own[1:], strict=False):
                if 100 * sizes[a] >= percent * sizes[b]:
                    label[label == label[b]] = label[a]
        got, links, entries = np.arange(n), [], []
        for salt in range(3):
            at = np.flatnonzero(np.arange(n) % 3 == salt)
            i, o, h, a, b = ngram_join._runs(item[at], sizes[at], sizes[at], at, percent)
            entries.append((i, sizes[o], h, o))
            links += zip(a, b, strict=True)
        *_, a, b = ngram_join._runs(*(np.concatenate(x) for x in zip(*entries, strict=True)), percent)
        for x, y in [*links, *zip(a, b, strict=True)]:
            got[got == got[y]] = got[x]
        assert len(set(zip(got.tolist(), label.tolist(), strict=True))) == len(set(label.tolist())) == len(set(got.tolist())), trial


def test_stages_decide_by_row(spark, odd, tmp_path):
    more = [(7, "a b c d e f g"), (7, f"{PASSAGE} one more"), (7, "quite another text of its own"), (5, "the leak is in here"), (5, "but not in this row at all"), (None, "say the leak is in here too"), (None, "x y"), (9, "x y"), (2, "12 34 !!"), (2, "12 34 !!")]
    docs = odd.union(table(spark, [t for _, t in more], [i for i, _ in more])).select(corpus_pipeline.COLUMNS)
    spark.createDataFrame([(1, "The leak IS in here")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    stages = dict(corpus_pipeline.STAGES)
    run = lambda name: sorted(((r.doc_id, r.text) for r in stages[name](spark, docs, str(tmp_path)).collect()), key=str)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert run("language_id") == sorted((r for r in rows if any(c.isalpha() for c in r[1] or "")), key=str)
    sets = [frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if (w := words(t, lower=True)) else None for _, t in rows]
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
                label = [label[a] if x == label[b] else x for x in label]
    order = lambda r: (r[0] is None, r[0] or 0, hashlib.md5(r[1].encode()).digest())
    kept = [r for r, own in zip(rows, sets, strict=True) if own is None]
    kept += [min((r for r, x, own in zip(rows, label, sets, strict=True) if x == one and own), key=order) for one in {x for x, own in zip(label, sets, strict=True) if own}]
    assert run("ngram_join") == sorted(kept, key=str)
    cut = brute_repeats([t for _, t in rows], [i for i, _ in rows], 50)
    assert sorted((i, len(words(t))) for i, t in run("substring_dedup") if i) == sorted((i, n - gone) for i, n, gone, _ in cut if i and (not gone or gone < n))
    assert run("decontamination") == sorted((r for r in rows if "the leak is in here" not in (r[1] or "")), key=str)


def test_stages_on_odd_tables(spark, tmp_path):
    """Empty tables, only nulls, and columns that clash with those that stages make."""
    spark.createDataFrame([(1, "The leak IS in here")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    nothing = table(spark, [])
    nulls = table(spark, [None, None, ""], [None, 1, 1])
    own = nulls.columns
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing.select(corpus_pipeline.COLUMNS), str(tmp_path)).count() == 0
        found = stage(spark, nulls, str(tmp_path))
        assert found.count() == {"language_id": 0}.get(name, 3), name
        clash = table(spark, [PASSAGE, f"{PASSAGE} more", "x y z"], [4, 5, 6]).withColumns({c: F.lit("z") for c in ("_row", "block", "digest", "key", "lang_pred", "score", "n_words", "turn", "bears", "ids")})
        assert stage(spark, clash, str(tmp_path)).select("doc_id").distinct().count() == {"ngram_join": 2}.get(name, 3), name
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "none" / "benchmark.parquet"))
    assert dict(corpus_pipeline.STAGES)["decontamination"](spark, nulls, str(tmp_path / "none")).count() == 3
    assert own == nulls.columns


def test_language_stage(spark):
    """The text decides where it is sure; labels stay where it is not; nothing is lost without labels."""
    words_ = {"x": "abab abba baab bbaa", "y": "cdcd dccd cddc ddcc"}
    rows = [(n, words_["xy"[n % 2]], "xy"[n % 2]) for n in range(80)] + [(90, words_["x"], "y"), (91, words_["y"], None), (92, "漢字", "zz"), (93, "12 !", "x"), (94, None, "x")]
    docs = spark.createDataFrame([(*r, "s", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    found = {r.doc_id: r.lang for r in corpus_pipeline.identify_language(spark, docs, "").collect()}
    assert (found[0], found[1], found[90], found[91]) == ("x", "y", "x", "y") and 92 in found and not {93, 94} & set(found)
    bare = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.doc_id for r in corpus_pipeline.identify_language(spark, bare, "").collect()} == set(found)


def test_tries_against_all_pairs():
    rng = np.random.default_rng(1)
    for trial in range(60):
        base = [rng.integers(0, 60, rng.integers(1, 25)) for _ in range(3)]
        sets = []
        for _ in range(rng.integers(2, 25)):
            one = base[rng.integers(3)].copy()
            new = rng.random(len(one)) < 0.1
            one[new] = rng.integers(0, 60, new.sum())
            sets.append(np.unique(one).astype(np.uint64))
        percent, wanted = int(rng.choice([50, 80, 100])), np.arange(len(sets))
        for a in range(len(sets)):
            for b in range(a):
                both = len(np.intersect1d(sets[a], sets[b]))
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    wanted[wanted == wanted[b]] = wanted[a]
        counts = Counter(np.concatenate(sets).tolist())
        ranks = [ngram_join.ranks_of(np.array([counts[x] for x in s.tolist()])) for s in sets]
        tree = tries.Trie(sets, ranks)
        found = tree.linked(percent, np.arange(len(sets)))
        assert len(set(zip(found.tolist(), wanted.tolist(), strict=True))) == len(set(wanted.tolist())) == len(set(found.tolist())), trial


def test_trees_prune_and_share():
    """A tree of many families looks at few pairs, and at what a family shares once."""
    rng = np.random.default_rng(2)
    families = [rng.choice(2**40, 200, replace=False).astype(np.uint64) for _ in range(40)]
    sets = [np.unique(np.concatenate([f[: 190 - n], rng.choice(2**40, 3).astype(np.uint64)])) for f in families for n in range(10)]
    counts = Counter(np.concatenate(sets).tolist())
    tree = tries.Trie(sets, [ngram_join.ranks_of(np.array([counts[x] for x in s.tolist()])) for s in sets])
    compared, real = [], tree._shared
    tree._shared = lambda run, seekers: (compared.append(len(seekers)), real(run, seekers))[1]
    found = tree.linked(80, np.arange(len(sets)))
    assert len(set(found.tolist())) == 40
    assert sum(compared) < 0.2 * len(sets) ** 2


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (200, 300), (300, 250)]
    found = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 200: 200, 250: 200, 300: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("most_edges", [1, 30])
def test_components_of_edges_taken_a_few_at_a_time(spark, most_edges):
    edges = spark.createDataFrame([(n, n + 1) for n in range(60)] + [(100, n) for n in range(101, 140)], "a long, b long").coalesce(1)
    found = {r.node: r.label for r in components(edges, most_edges=most_edges).collect()}
    assert found == {n: 0 if n < 100 else 100 for n in (*range(61), *range(100, 140))}


def test_joins_with_heavy_keys(spark):
    """A key with a third of all rows is joined without a shuffle of them; rows are those of a plain join."""
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).when(F.col("id") % 100 == 1, F.lit(None)).otherwise(F.col("id") % 700).alias("key"), F.col("id").alias("x"))
    names = rows.where("key IS NOT NULL AND key <> 5").groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("y"))
    for most_heavy in (1, 20, 10**9):
        found = join_counted(rows, names, "key", "n", most_heavy=most_heavy)
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, rows.join(names.drop("n"), "key").collect()))
        assert found.columns == ["key", "x", "y"]
    heavy = names.where(F.col("n") * 20 > names.agg(F.sum("n")).first()[0])
    assert [r.key for r in heavy.collect()] == [-1]
    assert join_counted(rows.limit(0), names.limit(0), "key", "n").count() == 0


def test_sets_are_told_apart_by_both_words_of_their_keys():
    """Keys with one word in common, and some that a fold to one word would take for equal, are classes of their own."""
    c = 0x9E3779B97F4A7C15
    keys = np.array([[0, 0], [c, 1], [c, 0], [0, 1], [0, 0], [c, 1]], np.uint64)
    at, same = ngram_join._distinct_keys(keys)
    assert len(at) == 4 and (keys[at][same] == keys).all()
    assert [tuple(k) for k in keys[at].tolist()] == sorted({tuple(k) for k in keys.tolist()})
    none = ngram_join._distinct_keys(np.zeros((0, 2), np.uint64))
    assert len(none[0]) == len(none[1]) == 0


@pytest.mark.parametrize("partitions", [1, 7])
@pytest.mark.parametrize("kind", ["long", "binary", "string"])
def test_components_of_random_edges(spark, partitions, kind):
    """Chains, stars and random edges over one partition and several, for nodes of each type."""
    rng = np.random.default_rng(partitions)
    pairs = [(n, n + 1) for n in range(100, 180)] + [(300, n) for n in range(301, 340)] + rng.integers(400, 600, (110, 2)).tolist() + [(7, 7), (5, 6), (6, 5)]
    least = {}
    for x in {x for a, b in pairs if a != b for x in (a, b)}:
        least[x] = x
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            if a != b and least[a] != least[b]:
                least[a] = least[b] = min(least[a], least[b])
                changed = True
    node = {"long": lambda c: c, "string": lambda c: F.lpad(c.cast("string"), 4, "0"), "binary": lambda c: F.lpad(c.cast("string"), 4, "0").cast("binary")}[kind]
    edges = spark.createDataFrame(pairs, "a long, b long").repartition(partitions).select(node(F.col("a")).alias("a"), node(F.col("b")).alias("b"))
    found = {int(r.node): int(r.label) for r in components(edges).collect()}
    assert found == least


def test_labels_within_a_partition():
    rng = np.random.default_rng(2)
    for n, m in ((1, 0), (2, 1), (50, 30), (1000, 900)):
        a, b = rng.integers(0, n, m), rng.integers(0, n, m)
        label = least_labels(a, b, n)
        assert (label[a] == label[b]).all() and (label <= np.arange(n)).all() and (label[label] == label).all()
    chain = np.arange(999)
    assert not least_labels(chain, chain + 1, 1000).any()


# 3: URL filter.


def test_urls(spark):
    rules = [("com/en/", "block"), ("example.com/en/7", "allow"), ("org/es/", "block")]
    given = [
        ("http://A.Example.COM/en/71?x", "a.example.com", "/en/71", "example.com/en/7"),
        ("http://example.com/en/8#t", "example.com", "/en/8", "com/en/"),
        ("http://xexample.com/en/7", "xexample.com", "/en/7", "com/en/"),
        ("https://a.org/es", "a.org", "/es", None),
        ("https://a.org?/es/", "a.org", "", None),
        ("x://poker-jackpot-slots.net", "poker-jackpot-slots.net", "", None),
        ("no host", "", "", None),
        ("", "", "", None),
        (None, "", "", None),
        ("a://b://c/d", "b:", "//c/d", None),
    ]
    pages = spark.createDataFrame([(n, g[0], "old") for n, g in enumerate(given)], "page_id long, url string, host string")
    model = urls.train(urls.labelled_table(spark))
    rows = urls.filter_urls(pages, rules, model).orderBy("page_id").collect()
    assert [(r.host, r.path, r.rule) for r in rows] == [g[1:] for g in given]
    verdicts = dict(rules)
    for r in rows:
        assert r.verdict == (verdicts[r.rule] if r.rule else "block" if r.block_score >= 0.5 else "allow")
    assert rows[5].verdict == "block"
    assert urls.filter_urls(pages.limit(0), rules, model).count() == 0
    assert urls.filter_urls(pages, [], model).where("rule IS NOT NULL").count() == 0


def test_url_scores_are_the_models(spark):
    model = urls.train(urls.labelled_table(spark))
    row = urls.hashed(spark.range(1).select(F.lit("casino.test").alias("_host"), F.lit("/en/1").alias("_path")), model.numFeatures).first()
    margin = model.intercept + sum(model.coefficients[int(i)] for i in row["_features"].indices)
    score = urls.filter_urls(spark.range(1).select(F.lit("x://casino.test/en/1").alias("url")), [], model).first().block_score
    assert score == pytest.approx(1 / (1 + math.exp(-margin)))


def brute_url(url, rules):
    head, found, rest = (url or "").partition("://")
    if not found:
        return "", "", None
    at = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host, rest = "".join(c.lower() if c.isascii() else c for c in rest[:at]), rest[at:]
    path = rest[: min((rest.find(c) for c in "?#" if c in rest), default=len(rest))]
    fits = [r for r, _ in rules if (host == (d := r.split("/")[0]) or host.endswith("." + d)) and path.startswith(r[len(d) :])]
    return host, path, max(fits, key=len, default=None)


def test_urls_against_brute_force(spark):
    rng = np.random.default_rng(12)
    rules = queries.URL_RULES
    parts = ["http", "://", "a.", "Example", ".com", ".net", "org", "/", "en/", "de/", "es/", "7", "8", "?", "#", ".", "É", "\n", "com/en/"]
    given = ["".join(rng.choice(parts, rng.integers(1, 12))) for _ in range(3000)] + [f"h://{d}{p}" for d in ("x.com", "example.com", "a.example.net", "b.org", "xnet", "net") for p in ("/en/7", "/de/8", "/es/", "/en", "?/en/", "/en/?x")] + [None, "", "x://" + "long/" * 20_000]
    pages = spark.createDataFrame(list(enumerate(given)), "page_id long, url string")
    model = urls.train(urls.labelled_table(spark, 50))
    for r in urls.filter_urls(pages, rules, model).collect():
        assert (r.host, r.path, r.rule) == brute_url(given[r.page_id], rules)
        assert r.verdict == (dict(rules)[r.rule] if r.rule else "block" if r.block_score >= 0.5 else "allow")


def judged_urls(known, asked):
    """Shares of the ordinary rows that are blocked, and of those to block."""
    found = urls.filter_urls(asked, [], urls.train(known))
    blocked = F.avg((F.col("verdict") == "block").cast("int"))
    by = {r["label"]: r["share"] for r in found.groupBy("label").agg(blocked.alias("share")).collect()}
    return by.get(0.0), by.get(1.0)


def test_urls_of_hosts_and_stems_that_were_held_out(spark):
    """Precision and recall on hosts, and on stems, that the model has not seen."""
    rows = urls.labelled_table(spark).cache()
    host = F.xxhash64(urls.host_of(F.col("url"))) % 5 == 0
    stem = F.coalesce(F.xxhash64(F.lit("held"), "stem") % 4 == 0, F.lit(False))
    wrong, right = judged_urls(rows.where(~host), rows.where(host))
    assert wrong < 0.03 and right > 0.85
    wrong, right = judged_urls(rows.where(~host & ~stem), rows.where((host & (F.col("label") == 0)) | stem))
    assert wrong < 0.03 and right > 0.25  # of stems never seen, what the rest of the host tells


def test_urls_sites_and_paths_carry_no_weight(spark):
    """The two kinds have the same schemes, sites, domains and paths, so that only names tell them apart."""
    rows = urls.labelled_table(spark)
    for part in (r"^(\w+)://", r"://(www\.|m\.|blog\.|shop\.|news\.)?", r"://[^/]*\.(\w+)/", r"://[^/]*(/.*)$"):
        shares = rows.groupBy(F.regexp_extract("url", part, 1)).agg(F.avg("label").alias("share")).collect()
        assert {r.share for r in shares} == {0.5}
    model = urls.train(rows)
    names = ["tharmod", "listwen", "chandpro", "gosterlin", "ruthnar", "penstol"]
    asked = spark.createDataFrame([(n, site, f"http://{site}{n}.example.net/en/7") for n in names for site in ("", "www.", "m.", "blog.", "shop.", "news.")], "name string, site string, url string")
    means = [r.score for r in urls.filter_urls(asked, [], model).groupBy("site").agg(F.avg("block_score").alias("score")).collect()]
    assert max(means) < 0.4 and max(means) - min(means) < 0.12


def test_urls_of_ordinary_pages_are_allowed(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    found = urls.filter_urls(pages.select("url"), queries.URL_RULES, urls.train(urls.labelled_table(spark))).where("rule IS NULL").collect()
    unwanted = re.compile("cheap-pills|casino-win|ads-track|adult-x|free-bets|spam-farm")  # the hosts made for this in the test tables
    assert all(r.verdict == "block" for r in found if unwanted.search(r.host))
    plain = [r.verdict for r in found if not unwanted.search(r.host)]
    assert plain.count("block") < 0.05 * len(plain)


def test_urls_with_other_columns_and_no_labels(spark):
    names = ["prediction", "probability", "rawPrediction", "_features", "_host", "_path", "_grams", "_row", "host", "a.b"]
    pages = spark.createDataFrame([("x://a.com/en/1", *[str(n) for n in range(len(names))])] * 2, ", ".join(["url string", *(f"`{n}` string" for n in names)]))
    model = urls.train(urls.labelled_table(spark, 20))
    for found in (urls.filter_urls(pages, queries.URL_RULES, model).collect(), urls.filter_urls(pages, queries.URL_RULES, urls.train(urls.labelled_table(spark).limit(0))).collect()):
        assert [(r.url, r.host, r.rule, r["_row"], r["a.b"], r.prediction) for r in found] == [("x://a.com/en/1", "a.com", "com/en/", "7", "9", "0")] * 2
    one = urls.train(spark.createDataFrame([("x://a.b", 1.0), (None, 1.0), ("x", None)], "url string, label double"))
    assert urls.filter_urls(pages.select("url"), [], one).first().verdict == "block"


# 4: substring deduplication.


def brute_repeats(texts, ids, size):
    order = [math.inf if i is None else i for i in ids]
    least = {}
    split = [words(t) for t in texts]
    for i, w in zip(order, split, strict=True):
        for p in range(len(w) - size + 1):
            key = tuple(w[p : p + size])
            least[key] = min(least.get(key, math.inf), i)
    out = []
    for i, own, w in zip(ids, order, split, strict=True):
        gone = {q for p in range(len(w) - size + 1) if least[tuple(w[p : p + size])] < own for q in range(p, p + size)}
        out.append((i, len(w), len(gone), " ".join(x for q, x in enumerate(w) if q not in gone)))
    return sorted(out, key=str)


@pytest.mark.parametrize("size, block_bytes", [(50, 8 << 20), (50, 300), (7, 300), (2, 300)])
def test_repeats(docs, size, block_bytes):
    found = sorted((tuple(r) for r in substrings.remove_repeats(docs, window=size, block_bytes=block_bytes).collect()), key=str)
    assert found == brute_repeats(TEXTS, list(range(len(TEXTS))), size)


def test_repeats_of_odd_and_empty_tables(spark, odd):
    rows = odd.collect()
    found = sorted((tuple(r) for r in substrings.remove_repeats(odd).collect()), key=str)
    assert found == brute_repeats([r.text for r in rows], [r.doc_id for r in rows], 50)
    assert substrings.remove_repeats(table(spark, [])).count() == 0
    kept = substrings.remove_repeats(odd, keep=["text", "lang"]).columns
    assert kept == ["doc_id", "text", "lang", "n_words", "n_removed", "kept_text"]


# 5: quality.


def brute_counts(t):
    t = t or ""
    w = words(t)
    lines = [line for line in t.split("\n") if words(line)]
    three = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    times = Counter(three)
    covered = {q for i, x in enumerate(three) if times[x] > 1 for q in range(i, i + 3)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered)


def test_statistics(docs):
    found = {r.doc_id: tuple(r[c] for c in quality.COUNTS) for r in quality.measure(docs).collect()}
    assert found == {i: brute_counts(t) for i, t in enumerate(TEXTS)}
    tricky = ["a\n\nb\na", "\na", "a\n", "\n", "a b\n a b\na b", "x x x x"]
    got = quality.statistics(text.Words(pa.array(tricky)))
    assert [tuple(int(got[c][k]) for c in quality.COUNTS) for k in range(len(tricky))] == [brute_counts(t) for t in tricky]


def test_forest_isolates_outliers():
    rng = np.random.default_rng(0)
    rows = np.vstack([rng.normal(0, 1, (900, 4)), rng.normal(0, 1, (100, 4)) + [0, 9, 0, 9]])
    good = np.arange(1000) < 900
    forest = quality.grow(rows)
    cut = quality.calibrate(forest, rows, good, 0.98)
    score = forest.score(rows)
    assert (score[good] > cut).mean() <= 0.02 and (score[~good] > cut).mean() > 0.9 and 0 <= score.min() and score.max() <= 1


def test_forest_against_brute_force():
    """Path lengths by walking each tree one row at a time, with the usual path of what a leaf holds."""
    rng = np.random.default_rng(5)
    rows = rng.normal(0, 1, (300, 3))
    forest = quality.grow(rows, trees=10, subsample=64)
    usual = lambda n: 0.0 if n < 2 else 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n
    for row, score in zip(rows[:40], forest.score(rows[:40]), strict=True):
        total = 0.0
        for which, value, left, right, path in forest.trees:
            at = 0
            while which[at] >= 0:
                at = left[at] if row[which[at]] < value[at] else right[at]
            total += path[at]
        assert score == pytest.approx(2 ** (-total / 10 / usual(64)))
    assert [float(quality._usual_path(n)) for n in (0, 1, 2, 64)] == pytest.approx([usual(n) for n in (0, 1, 2, 64)])


def test_training_rows_are_bounded_and_unique(spark, monkeypatch):
    given = table(spark, ["word " + " ".join(f"w{n}x{k}" for k in range(60)) for n in range(300)] + ["same " * 3 + " ".join(f"v{k}" for k in range(70))] * 200, [*range(300), *[999] * 200])
    labels = spark.createDataFrame([(n, 1) for n in range(290)] + [(n, 0) for n in range(280, 300)] + [(999, 1)] * 300, "doc_id long, quality int")
    grown = []
    real = quality.grow
    monkeypatch.setattr(quality, "grow", lambda rows: (grown.append(len(rows)), real(rows))[1])
    forest = quality.train(quality.measure(given), labels)
    assert grown == [146]  # 291 ids with one label, half of them
    assert 0 < forest.threshold <= 1


def test_every_row_grows_a_tree():
    """Root spans count a tree's rows: up to 256 rows grow all trees, of more each grows one at least, and trees stay even."""
    for n in (1, 100, 256, 257, 3000, 40_000):
        size = min(n, max(256, -(-n // 100)))
        share = (size * 100 / n - 1) / 99 if size <= 256 else 0.0
        row, tree = quality._members(quality._mixed(np.arange(n, dtype=np.uint64)), 100, share)
        assert set(row) == set(range(n)) and len(set(zip(row, tree, strict=True))) == len(row)
        each = np.bincount(tree, minlength=100)
        assert (each == n).all() if n <= 256 else abs(each - size).max() < 6 * size**0.5
    forest = quality.grow(np.repeat(np.arange(40_000.0), 2).reshape(-1, 2))
    assert forest.subsample == 400 and len(forest.trees) == 100 and max(len(t[0]) for t in forest.trees) < 512


def rates_table(spark, rows, **more):
    columns = {c: rows[:, k] for k, c in enumerate(quality.RATES)} | more
    return spark.createDataFrame(pa.table(columns)).repartition(7)


def test_spread_rows_grow_and_calibrate_as_arrays_do(spark):
    rng = np.random.default_rng(8)
    rows, good = rng.normal(0, 1, (3000, len(quality.RATES))), np.arange(3000) < 2700
    rows[~good, 2:5] += 3
    keys = quality._mixed(np.arange(3000, dtype=np.uint64)).view(np.int64)
    here, there = quality.grow(rows), quality.grow(quality.Spread(rates_table(spark, rows, _key=keys), 3000))
    assert here.subsample == there.subsample == 256
    assert all((a == b).all() for x, y in zip(here.trees, there.trees, strict=True) for a, b in zip(x, y, strict=True))
    for marks in (good, good | True, good & False, rng.random(3000) < 0.5):
        given = rates_table(spark, rows, quality=marks.astype(np.int32))
        for keep in (0.985, 0.7):
            for bins in (1, 1 << 16):
                assert quality.calibrate_spread(here, given, keep, bins=bins) == pytest.approx(quality.calibrate(here, rows, marks, keep), rel=1e-12)


def test_all_labelled_rows_train(spark, monkeypatch):
    """30,000 labelled rows: half of them grow the forest, and the threshold is that of all others."""
    n = 30_000
    rng = np.random.default_rng(9)
    rows, good = rng.random((n, len(quality.RATES))), np.arange(n) % 10 > 0
    rows[~good, 3] += 0.4
    measured = rates_table(spark, rows, doc_id=np.arange(n)).select("doc_id", *(F.lit(100 if c == "n_words" else 0).cast("long").alias(c) for c in quality.COUNTS), *quality.RATES)
    grown, real = [], quality.grow
    monkeypatch.setattr(quality, "grow", lambda rows: (grown.append(len(rows)), real(rows))[1])
    forest = quality.train(measured, spark.createDataFrame(pa.table({"doc_id": np.arange(n), "quality": good.astype(np.int32)})))
    assert grown == [n // 2] and forest.subsample == 256
    ranked = [r.doc_id for r in measured.orderBy(F.xxhash64(F.lit("half"), "doc_id")).select("doc_id").collect()]
    other = ranked[: n // 2]
    assert forest.threshold == pytest.approx(quality.calibrate(forest, rows[other], good[other], 0.985), rel=1e-12)


def test_judging(spark, docs):
    rng = np.random.default_rng(6)
    vocabulary = np.array(["".join(rng.choice(list("abcdefgh"), rng.integers(2, 9))) for _ in range(2000)])
    plain = [" ".join(rng.choice(vocabulary, rng.integers(60, 200))) for _ in range(320)]
    texts = [t.replace(" ", "### ") if i >= 300 else t for i, t in enumerate(plain)]
    own = table(spark, texts)
    labels = spark.createDataFrame([(i, int(i < 300)) for i in range(320)] + [(None, 1), (1, None)], "doc_id long, quality int")
    measured = quality.measure(own)
    forest = quality.train(measured, labels)
    kept = {r.doc_id: r.kept for r in quality.judge(measured, forest).collect()}
    assert sum(kept[i] for i in range(300)) >= 295 and sum(kept[i] for i in range(300, 320)) <= 2
    base = {r.doc_id: r.base_failed for r in quality.judge(quality.measure(docs), None).collect()}
    for i, t in enumerate(TEXTS):
        n, _, _, _, repeat = brute_counts(t)
        assert base[i] == (n < 50 or 100 * repeat > 50 * n)
    assert quality.train(measured, labels.limit(0)) is None
    assert quality.judge(quality.measure(table(spark, [])), None).count() == 0


# 6 and 9: tokens.

ODD_TEXTS = ["", "a", "a  b", " a\nb ", "don't  'll\n\nx", "x\u00a0y\x85z \x1c q", "ǅ İ Σς ΑΣ\u0301", "<|endoftext|> <|startoftext|>", "漢字 かな 12 345", "tab\there\r\nnew"]


@pytest.mark.parametrize("special_as_text", [False, True])
@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_gives_the_librarys_ids(name, special_as_text):
    path = public_tokenizers.path(name)
    direct = Tokenizer.from_file(path)
    direct.encode_special_tokens = special_as_text
    own = encoding.Encoder(path, special_as_text)
    rng = np.random.default_rng(2)
    pieces = ["a", "é", "É", "×", "'s", " ", "  ", "\n", ".", "(", "12", "İ", "\t", "Word", "\u0301", "🙂", "\u3000", "\xa0", "\x85", "\x1c", "<|endoftext|>", "\r"]
    texts = [None, *ODD_TEXTS, *TEXTS, *("".join(rng.choice(pieces, rng.integers(1, 14))) for _ in range(4000))]
    for end, given in ((None, pa.array(texts, pa.string())), (7, pa.array(["x", *texts], pa.large_string()).slice(1))):
        ids, bounds = own.encode(given, end)
        for t, lo, hi in zip(texts, bounds, bounds[1:], strict=False):
            assert ids[lo:hi].tolist() == direct.encode(t or "", add_special_tokens=False).ids + ([] if end is None else [end])
    assert own.encode(pa.array([], pa.string()))[0].size == 0


def test_encoder_forgets(monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    monkeypatch.setattr(encoding, "MOST_PIECES", 10)
    own, direct = encoding.Encoder(path), Tokenizer.from_file(path)
    for n in range(5):
        text = " ".join(f"word{k}" for k in range(n, n + 20))
        assert own.encode(pa.array([text]))[0].tolist() == direct.encode(text, add_special_tokens=False).ids
    assert own.begin.n <= 40


def encoded(path, texts, end):
    own = Tokenizer.from_file(path)
    return [np.array(own.encode(t or "", add_special_tokens=False).ids + [end], "<u4") for t in texts]


@pytest.mark.parametrize("part_bytes, width", [(1 << 25, 4), (500, 2)])
def test_token_files(spark, docs, tmp_path, part_bytes, width):
    path, folder = public_tokenizers.path("byte_bpe_50k.json"), f"file://{tmp_path}/t"
    manifest = token_files.write_token_files(docs, folder, path, 2, width=width, part_bytes=part_bytes)
    rows = token_files.read_token_files(manifest, folder).orderBy("doc_id").collect()
    start = 0
    for r, ids in zip(rows, encoded(path, TEXTS, 2), strict=True):
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_token_files_of_odd_and_empty_tables(spark, odd, tmp_path):
    path, folder = public_tokenizers.path("byte_bpe_50k.json"), f"file://{tmp_path}/t"
    rows = token_files.read_token_files(token_files.write_token_files(odd, folder, path, 2), folder).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, None, None, 3, 3, 7, 7] and rows[0].n_tokens == 1
    assert token_files.read_token_files(token_files.write_token_files(table(spark, []), folder, path, 2), folder).count() == 0


def check_packing(rows, texts, path, capacity, end=1):
    ids = encoded(path, texts, end)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r.doc_tokens == len(ids[r.doc_id]) and r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
        by_doc[r.doc_id].append((r.start, r.length))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for d, x in enumerate(ids):
        at = 0
        for start, length in sorted(by_doc[d]):
            assert start == at
            at += length
        assert at == len(x)
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert 0 < at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding


@pytest.mark.parametrize("block_bytes", [4 << 20, 400])
def test_packing(docs, block_bytes):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = packing.pack_documents(docs, path, 1, capacity=256, segments=8, block_bytes=block_bytes).collect()
    assert check_packing(rows, TEXTS, path, 256) == 0


def test_packing_of_odd_and_empty_tables(spark, odd):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = packing.pack_documents(odd, path, 1).collect()
    assert sum(r.length for r in rows) == sum(len(x) for x in encoded(path, [r.text for r in odd.collect()], 1))
    assert packing.pack_documents(table(spark, []), path, 1).count() == 0


def check_filling(sequences, lengths, loss, limits, cut):
    seen = Counter()
    for members in sequences:
        assert members and sum(b - a for _, a, b in members) <= limits[0] and len(members) <= limits[1]
        assert sum(min(loss[k], b - a) for k, a, b in members) <= limits[2]
        for k, a, b in members:
            assert a == seen[k] and b > a if cut else (a, b) == (0, lengths[k])
            seen[k] += b - a
    assert [seen[k] for k in range(len(lengths))] == lengths.tolist()


def test_filling_keeps_all_limits():
    rng = np.random.default_rng(3)
    for trial in range(30):
        n, limits = int(rng.integers(0, 300)), (200, int(rng.integers(1, 9)), int(rng.integers(20, 200)))
        lengths = rng.integers(1, 201, n)
        bears = rng.random(n) < 0.5
        lengths[bears] = np.minimum(lengths[bears], limits[2])
        loss = np.where(bears, lengths, 0)
        whole, cuts = packing.fill(lengths, loss, limits, False), packing.fill(lengths, loss, limits, True)
        check_filling(whole, lengths, loss, limits, False)
        check_filling(sorted(cuts, key=lambda m: 0), lengths, loss, limits, True)
        part = np.minimum(loss, 20)  # some ids bear loss
        check_filling(packing.fill(lengths, part, limits, False), lengths, part, limits, False)
    many = rng.integers(1, 40, 40_000)
    sequences = packing.fill(many, many, (2048, 256, 2048), True)
    check_filling(sequences, many, many, (2048, 256, 2048), True)
    assert len(sequences) <= 1.05 * many.sum() / 2048  # short pieces come last, where segments are what is scarce
    with pytest.raises(ValueError):
        packing.fill(np.array([5]), np.array([0]), (4, 1, 4), True)


def test_filling_takes_what_fits_the_scarce_room():
    """Prompts and answers are mixed, so that neither room is left over: first-come filling needs more sequences."""
    lengths = np.array([50] * 60 + [50] * 60)
    loss = np.array([50] * 60 + [0] * 60)
    best = packing.fill(lengths, loss, (200, 8, 100), False)
    assert len(best) == 30 and all(sum(loss[k] for k, _, _ in m) == 100 for m in best)


def test_packing_of_turns(spark):
    rng = np.random.default_rng(4)
    path = public_tokenizers.path("word_bpe_49k.json")
    roles, texts = ["user", "assistant", "system", None], ["", None, "a b c", LONG[:4000], "hello there " * 40]
    rows = [(int(rng.integers(0, 5)) if n % 9 else None, n, roles[n % 4], texts[int(rng.integers(0, 5))], "x", n) for n in range(120)]
    rows += [(7, 500, "assistant", "the same", "x", 1)] * 30
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, block string, ids long").repartition(3)
    for block_bytes in (4 << 20, 2000):
        found = packing.pack_turns(given, path, 1, capacity=256, segments=6, loss_tokens=100, block_bytes=block_bytes).collect()
        by_sequence, by_turn = defaultdict(list), defaultdict(list)
        for r in found:
            by_sequence[r.sequence_id].append(r)
            by_turn[r.turn].append(r)
        for own in by_sequence.values():
            assert sum(r.length for r in own) <= 256 and len(own) <= 6 and sum(r.loss for r in own) <= 100
            at = 0
            for r in sorted(own, key=lambda r: r.offset):
                assert r.offset == at
                at += r.length
        ids = dict(zip([r[1] for r in rows], encoded(path, [r[3] for r in rows], 1), strict=True))
        for turn, own in by_turn.items():
            times = 30 if turn == 500 else 1
            assert sum(r.length for r in own) == times * len(ids[turn])
            for r in own:
                assert r.ids_crc32 == zlib.crc32(ids[turn][r.start : r.start + r.length].tobytes()) and r.doc_tokens == len(ids[turn])
                assert r.loss == (r.length if turn == 500 or roles[turn % 4] == "assistant" else 0)
        assert set(by_turn) == set(ids)
    used = [(sum(r.length for r in own), len(own), sum(r.loss for r in own)) for own in by_sequence.values()]
    assert packing.pack_turns(given.limit(0), path, 1).count() == 0 and max(n for _, n, _ in used) == 6


# 7: decontamination.


def test_leaks(spark, docs):
    items = [PASSAGE, " ".join(PASSAGE.split()[:40] + ["other"] * 3), "b c D e f g", "two three", "one", "absent words here now again", None, "", "a b c d e f g h"]
    bench = spark.createDataFrame([(n, t, "x") for n, t in enumerate(items)], "item_id long, text string, lang string")
    wanted = set()
    for d, t in enumerate(TEXTS):
        w = words(t, lower=True)
        for n, item in enumerate(items):
            v = words(item, lower=True)
            k = min(5, len(v))
            own = {tuple(v[i : i + k]) for i in range(len(v) - k + 1)} if k else set()
            there = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if k else set()
            if own and 100 * len(own & there) >= 80 * len(own):
                wanted.add((d, n, len(own), len(own & there)))
    for block_bytes in (1 << 20, 300):
        assert {tuple(r) for r in decontaminate.find_leaks(docs, bench, block_bytes=block_bytes).collect()} == wanted
    for block_bytes in (8 << 20, 1):
        assert {r.doc_id for r in decontaminate.leak_free(docs, bench, block_bytes=block_bytes).collect()} == set(range(len(TEXTS))) - {d for d, *_ in wanted}
    assert decontaminate.find_leaks(docs, bench.limit(0)).count() == 0
    assert decontaminate.find_leaks(table(spark, []), bench).count() == 0


# 8: language.


def test_language(spark):
    rng = np.random.default_rng(4)
    parts = {"aa": ["the", "and", "ing", "tion"], "bb": ["der", "und", "sch", "ein"], "cc": ["que", "les", "eau", "ment"], "dd": ["жил", "был", "кот", "дом"]}
    rows = []
    for i in range(400):
        lang = list(parts)[i % 4]
        rows.append((i, " ".join("".join(rng.choice(parts[lang], 2)) for _ in range(30)), lang))
    rows += [(400, None, "aa"), (401, "12 !!", "aa"), (402, "", None), (None, "theand thetion", None), (404, "кот", "dd")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(docs.where("coalesce(doc_id, 0) % 3 <> 1"), per_language=50)
    found = language.identify(docs, model).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    right = [r.lang_pred == rows[r.doc_id][2] for r in found if r.doc_id is not None and r.doc_id < 400 and r.doc_id % 3 == 1]
    assert np.mean(right) > 0.97
    by = {r.doc_id: r for r in found}
    assert by[400].lang_pred == by[401].lang_pred == by[402].lang_pred == "und" and by[None].lang_pred == "aa" and by[404].lang_pred == "dd"
    assert language.train(docs.where("lang IS NULL")) is None
    assert {r.lang_pred for r in language.identify(docs, None).collect()} == {"und"}
    assert language.identify(docs.limit(0), model).count() == 0


def test_language_decoding(spark):
    """Each bit's logistic loss, weighted by the bit's accuracy, against a loop; two close codewords are ambiguous."""
    rng = np.random.default_rng(3)
    model = language.fit(rng.random((60, 20)).astype(np.float32), [f"l{n % 3}" for n in range(60)])
    rows = rng.random((10, 20)).astype(np.float32)
    found = model.losses(rows)
    for n, row in enumerate(rows):
        for k in range(3):
            loss = sum(model.trust[b] * math.log1p(math.exp(-model.code[k, b] * (row @ model.weights[:, b] + model.bias[b]))) for b in range(model.code.shape[1]))
            assert found[n, k] == pytest.approx(loss, rel=1e-4)
    docs = spark.createDataFrame([(n, t, lang) for n, (t, lang) in enumerate([("abab abba baab", "x"), ("cdcd dccd cddc", "y")] * 40)], "doc_id long, text string, lang string")
    model = language.train(docs)
    asked = spark.createDataFrame([(1, "abab abba"), (2, "cdcd dccd"), (3, "zzz"), (4, "abab cdcd")], "doc_id long, text string")
    by = {r.doc_id: r for r in language.identify(asked, model).collect()}
    assert (by[1].lang_pred, by[2].lang_pred) == ("x", "y") and not by[1].ambiguous and not by[2].ambiguous
    sure = {r.doc_id: r.ambiguous for r in language.identify(asked, model, close=1.1).collect()}
    assert all(sure.values()) and by[4].score < by[1].score


def test_language_sample_is_bounded(spark, monkeypatch):
    docs = spark.range(3000).select(F.lit(1).alias("doc_id"), F.lit("the same text").alias("text"), F.lit("en").alias("lang")).union(spark.range(50).select("id", F.lit("autre texte"), F.lit("fr")))
    sizes = []
    real = language.fit
    monkeypatch.setattr(language, "fit", lambda rows, labels: (sizes.append(Counter(labels)), real(rows, labels))[1])
    assert language.identify(docs, language.train(docs, per_language=20)).where("lang_pred IN ('en', 'fr')").count() == 3050
    assert sizes[0]["en"] <= 1 + 20 and 1 <= sizes[0]["fr"] <= 45


@pytest.mark.parametrize("n", [1, 2, 3, 4, 17, 60])
def test_codewords_are_apart(n):
    code = language.codewords(n)
    apart = [(code[a] != code[b]).sum() for a in range(n) for b in range(a)]
    assert code.shape[0] == n and (not apart or min(apart) >= 1)


# 10: language model.


def brute_scores(texts, ids, held):
    """The same model by recursion over dictionaries of words."""
    split = [words(t, lower=True) + [None] for t in texts]
    one, two, three, kept = Counter(), Counter(), Counter(), defaultdict(dict)
    for h, w in zip(held, split, strict=True):
        if not h:
            one.update(w)
            two.update(zip([0, *w], w, strict=False))
            three.update(zip([0, *w], w, w[1:], strict=False))
    times, after = Counter(two.values()), Counter(h for h, _ in two)
    d = round(1024 * min(max(times[1] / (times[1] + 2 * times[2]), 0.1), 0.95)) / 1024 if times[1] + times[2] else 0.5
    for (u, v, w), c in three.items():
        kept[u, v][w] = c
    total, scale = sum(one.values()), sum(one.values()) + 0.1 * (len(one) + 1)

    def chance(w, history=()):
        if not history:
            return (one[w] + 0.1) / scale
        if len(history) == 1:
            n = one[None] if history[0] == 0 else one[history[0]]
            if not n:
                return chance(w)
            rest = d * after[history[0]] / n * chance(w)
            return (two[history[0], w] - d) / n + rest if two[history[0], w] else rest
        if history not in kept:
            return chance(w, history[1:])
        n = two[history]
        rest = (1 - sum(c - d for c in kept[history].values()) / n) * chance(w, history[1:])
        return (kept[history][w] - d) / n + rest if w in kept[history] else rest

    out = []
    for i, h, w in zip(ids, held, split, strict=True):
        known = [0, *w]
        found = sum(math.log10(chance(x, tuple(known[max(0, n - 1) : n + 1]))) for n, x in enumerate(w))
        out.append((i, h, len(w), sum(one[x] > 0 for x in w), total, sum(math.log10(chance(x)) for x in w), found))
    for history in [*list(kept)[:3], *[(h,) for h in list(after)[:3]], ()]:
        assert not one or math.isclose(sum(chance(w, history) for w in one) + chance("never seen", history), 1)
    return out


MORE = [" ".join(f"r{(7 * i * i + n) % 23}" for i in range(60)) for n in range(4)] * 2 + ["r1 r2 r3 unknown r4 r5", PASSAGE, "r5 r6"]


@pytest.mark.parametrize("block_bytes", [4 << 20, 200])
@pytest.mark.parametrize("texts", [TEXTS, TEXTS + MORE])
def test_scores(spark, texts, block_bytes):
    held = [zlib.crc32(str(i).encode()) % 10 == 0 for i in range(len(texts))]
    rows = sorted(lm.score(table(spark, texts).repartition(3), held_out=lm.held_out_tenth("doc_id"), block_bytes=block_bytes).collect(), key=lambda r: r.doc_id)
    for r, wanted in zip(rows, brute_scores(texts, range(len(texts)), held), strict=True):
        assert tuple(r)[:5] == wanted[:5]
        assert r.base_score == pytest.approx(wanted[5], abs=1e-6) and r.score == pytest.approx(wanted[6], abs=1e-6)


def test_scores_of_odd_and_empty_tables(spark, odd):
    rows = odd.collect()
    found = lm.score(odd).collect()
    wanted = brute_scores([r.text for r in rows], [r.doc_id for r in rows], [False] * len(rows))
    assert sorted(r.score for r in found) == pytest.approx(sorted(w[6] for w in wanted))
    assert lm.score(table(spark, [])).count() == 0
    none = lm.score(odd, held_out=F.lit(True)).collect()
    assert {(r.train_tokens, r.n_known) for r in none} == {(0, 0)} and all(math.isfinite(r.score) for r in none)


def test_scores_tell_apart_what_was_seen(spark):
    rng = np.random.default_rng(8)
    new = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 60, n))
    texts = [new(80) for _ in range(120)]
    twice, fresh = texts[:20], [new(80) for _ in range(20)]
    all_texts = [*texts, *twice, *fresh]
    rows = lm.score(table(spark, all_texts), held_out=F.col("doc_id") >= 140).collect()
    per = {r.doc_id: r.score / r.n_tokens for r in rows}
    seen, once, unseen = ([per[i] for i in x] for x in (range(20), range(20, 120), range(140, 160)))
    assert min(seen) > max(once) and np.mean(once) > np.mean(unseen)


def automaton(texts, held=()):
    rows = pa.table({"doc_id": range(len(texts)), "text": texts, "held_out": [i in held for i in range(len(texts))], "block": [0] * len(texts)})
    block = lm.Block(rows, 1)
    answers = lambda step, keys, counts: pa.table({"step": [step], "part": [0], "about": [blocks.encoded(lm.summed(np.arange(len(keys)), len(keys), counts), "count")]}).slice(0, min(1, len(keys)))
    block.counted(answers(0, block.keys, block.own_counts()))
    block.triples()
    block.kept(answers(1, *block.second()))
    less = lm.discount(*lm.corpus_counts(block.keys, np.arange(len(block.keys)), block.own_counts())[2:])
    block.weighed(answers(2, *block.third()))
    total, types, *_ = lm.corpus_counts(block.keys, np.arange(len(block.keys)), block.own_counts())
    return block, lm.Automaton(block, total, types, less)


def test_lanes_lead_to_the_same_states():
    rng = np.random.default_rng(9)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 12, n)) for n in (0, 1, 2, 3, 50, 64, 65, 400)]
    block, found = automaton(texts, held=(7,))
    whole = found.walk(block.word, block.first, lane=10_000)
    for lane in (2, 3, 7, 64):
        assert found.walk(block.word, block.first, lane=lane) == pytest.approx(whole)


def test_arcs_and_failures():
    block, found = automaton(["a b c", "a b c", "a b d", "x b e", "x c b"], held=(4,))
    by = {name: block.word[n] for n, name in enumerate("a b c".split())} | {"d": block.word[10], "x": block.word[12], "e": block.word[14]}
    read = lambda *words: found.step(*[np.array([x]) for x in (read(*words[:-1])[1][0] if words else 0, by[words[-1]])]) if words else (0, [found.start])
    pair = block.pair[1] + 1
    assert read("a", "b")[1] == pair and found.fail[pair] == by["b"] + 1 and found.fail[by["b"] + 1] == 0
    kept, once, failed, twice = (read("a", "b", w)[0][0] for w in "cdex")
    from_b = {w: found.step(np.array([by["b"] + 1]), np.array([by[w]]))[0][0] for w in "cdex"}
    assert kept > once > failed and kept > from_b["c"] and failed == pytest.approx(found.fail_weight[pair] + from_b["e"])
    assert twice == pytest.approx(found.fail_weight[pair] + found.fail_weight[by["b"] + 1] + found.null[by["x"]])
    assert read("x", "c")[1] == by["c"] + 1  # the pair occurs in no training text, and is no state


# All operators: columns with names of their own.

OWN_NAMES = ["_salt", "_salt_of_shards", "_text", "_bucket", "_record", "_own", "_row_of__salt", "_all", "_0", "_1", "_n", "_base", "_at", "_shard", "row", "id", "n", "terms", "counts", "key", "part", "a", "b", "held_out", "score", "vector", "rank"]


def test_columns_of_any_name_do_no_harm(spark):
    texts = TEXTS[:13]
    plain = table(spark, texts).select("doc_id", "text", "lang")
    named = plain.select("*", *(F.lit("x").alias(c) for c in OWN_NAMES))
    items = spark.createDataFrame([(1, "a b c d e f g"), (2, PASSAGE)], "item_id long, text string").select("*", *(F.lit("x").alias(c) for c in OWN_NAMES))
    path = public_tokenizers.path("byte_bpe_50k.json")
    same = lambda made: sorted(map(str, made(named).collect())) == sorted(map(str, made(plain).collect()))
    assert same(lambda d: ngram_join.join_similar(d))
    assert same(lambda d: substrings.remove_repeats(d, block_bytes=300))
    assert same(lambda d: quality.measure(d))
    assert same(lambda d: decontaminate.find_leaks(d, items))
    assert same(lambda d: language.identify(d, language.train(d)))
    assert same(lambda d: packing.pack_documents(d, public_tokenizers.path("word_bpe_49k.json"), end_id=1).select("doc_id", "start", "length", "doc_tokens"))
    assert same(lambda d: lm.score(d, block_bytes=300))
    assert same(lambda d: lexical.search(d, items))
    manifest = token_files.write_token_files(named, folder := new_path(spark, "token-files"), path, end_id=2, width=2)
    assert token_files.read_token_files(manifest, folder).count() == len(texts)
    sharded = shards.shuffle_into_shards(named, 3)
    assert sharded.columns == [*named.columns, "shard", "slot"] and sharded.count() == len(texts) and sharded.where("_salt = 'x' AND _record = 'x'").count() == len(texts)
    judged = urls.filter_urls(named.withColumn("url", F.lit("x://a.com/en/1")), queries.URL_RULES, None)
    assert judged.where("rule = 'com/en/' AND _salt = 'x'").count() == len(texts)
    kept = language.identify(named, language.train(named), keep=["_text", "text", "_salt", "_0"])
    assert kept.columns[:5] == ["doc_id", "_text", "text", "_salt", "_0"] and kept.where("_text = 'x'").count() == len(texts)
    assert corpus_pipeline.join_near_copies(spark, named.withColumns({"source": F.lit("s"), "n_chars": F.lit(1)}), "").columns == corpus_pipeline.COLUMNS


def test_a_large_benchmark_is_joined_in_one_plan(spark, odd):
    """The join gives what the broadcast gives, and its plan does not grow with the benchmark."""
    rng = np.random.default_rng(21)
    new = lambda n: " ".join(f"b{x}" for x in rng.integers(0, 90, n))
    items = [(i, new(rng.integers(1, 40))) for i in range(60)] + [(7, PASSAGE), (None, "one two three"), (8, None), (9, " "), (10, "a b c d e f g h"), (10, "a b c d e f g h")]
    texts = [f"{new(30)} {t} {new(5)}" for _, t in items[:40]] + [f"{new(5)} {' '.join((t or '').split()[:-1])} {new(400)}" for _, t in items[20:]]
    docs = odd.unionByName(table(spark, texts + texts[:9])).repartition(4)
    bench = spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id long, text string, digest string, row int")
    found = {b: Counter(map(tuple, decontaminate.find_leaks(docs, bench, block_bytes=b).collect())) for b in (8 << 20, 1)}
    assert found[1] == found[8 << 20] and len(found[1]) > 60
    clean = {b: Counter(map(str, decontaminate.leak_free(docs, bench, block_bytes=b).collect())) for b in (8 << 20, 1)}
    assert clean[1] == clean[8 << 20] and 0 < sum(clean[1].values()) < docs.count()
    plan = lambda items: decontaminate.leak_free(docs, items, block_bytes=1)._jdf.queryExecution().executedPlan().toString()
    assert plan(bench).count("MapInArrow") == plan(bench.limit(2)).count("MapInArrow") == 0  # what the last join reads is stored
    assert decontaminate.find_leaks(docs.limit(0), bench, block_bytes=1).count() == 0
