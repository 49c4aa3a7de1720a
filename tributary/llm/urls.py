"""URL filter: longest-matching rules first, then logistic regression on hashed character n-grams of host and path."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MOST_LABELS = 100_000

# Parts of the URLs in the labelled table, invented for this package.
UNWANTED = (
    "ads", "adult", "bet", "betting", "bingo", "bonus", "casino", "cash", "cheap", "click", "crack", "credit", "dating", "deal", "escort", "free", "gambling", "hot", "jackpot", "keygen",
    "loan", "lotto", "lucky", "meds", "pharma", "pills", "poker", "popup", "porn", "promo", "prize", "rich", "roulette", "sale", "sex", "slots", "spam", "torrent", "track", "traffic", "viagra", "warez", "win", "xxx",
)
ONSETS = ("b", "c", "d", "f", "g", "h", "k", "l", "m", "n", "p", "r", "s", "t", "v", "w", "ch", "pr", "sh", "st", "th", "tr")
CODAS = ("", "", "", "d", "l", "n", "nd", "ng", "r", "s", "st", "t")
DOMAINS = ("com", "net", "org", "test", "example.com", "example.net", "example.org")
SITES = ("", "www.", "m.", "blog.", "shop.", "news.")
LANGUAGES = ("en", "de", "fr", "es", "it")


def labelled_table(spark: SparkSession, n: int = 4000, seed: int = 11) -> DataFrame:
    """(url, label, stem): a small table of invented URLs, half of them to block (1). Give another one with url and label.

    Rows come in pairs that share scheme, site, domain and path, so that none of these weighs; only names differ. An
    ordinary name is made of one to four random syllables, and may have a hyphen or a number. A name to block holds one
    of 44 stems, alone or beside a second stem, syllables or a number, with a hyphen more often than not. ``stem`` is
    that stem, null for ordinary names.
    """
    if n > MOST_LABELS:
        raise ValueError(f"at most {MOST_LABELS} rows")
    pair = F.expr("id div 2")

    def drawn(salt: str, below: int, key: Column | None = None) -> Column:
        return F.pmod(F.xxhash64(F.lit(seed), F.lit(salt), F.col("id") if key is None else key), F.lit(below)).cast("int")

    def one_of(salt: str, words: tuple[str, ...], key: Column | None = None) -> Column:
        return F.element_at(F.array(*map(F.lit, words)), drawn(salt, len(words), key) + 1)

    def syllable(salt: str) -> Column:
        bare = drawn(f"{salt} bare", 6) == 0  # an onset only: names are not all easy to say
        return F.concat(one_of(f"{salt} onset", ONSETS), F.when(bare, "").otherwise(F.concat(one_of(f"{salt} vowel", ("a", "e", "i", "o", "u")), one_of(f"{salt} coda", CODAS))))

    def made(salt: str) -> Column:
        return F.concat(syllable(f"{salt} 1"), *(F.when(drawn(f"{salt} more", 3) >= k, syllable(f"{salt} {k + 1}")).otherwise("") for k in (1, 2)))

    number = F.when(drawn("numbered", 6) == 0, drawn("number", 999).cast("string")).otherwise("")
    ordinary = F.concat(made("a"), F.when(drawn("joined", 4) == 0, F.concat(F.lit("-"), made("b"))).otherwise(""), number)
    stem, second = one_of("stem", UNWANTED), F.when(drawn("which", 2) == 0, one_of("second", UNWANTED)).otherwise(made("a"))
    link = F.when(drawn("link", 4) == 0, "").otherwise("-")
    forms = [F.concat(stem, link, second), F.concat(stem, link, second), F.concat(second, link, stem), F.concat(stem, number)]
    unwanted = F.element_at(F.array(*forms), drawn("form", len(forms)) + 1)
    to_block = F.col("id") % 2 == 1
    short = F.concat(F.lit("/"), one_of("language", LANGUAGES, pair), F.lit("/"), drawn("n", 1000, pair).cast("string"), one_of("end", ("", "/", ".html"), pair))
    deep = F.concat(F.lit("/"), one_of("folder", ONSETS, pair), one_of("vowel", ("a", "e", "i", "o", "u"), pair), one_of("slash", ("/", "-", "_"), pair), drawn("page", 99, pair).cast("string"))
    host = F.concat(one_of("site", SITES, pair), F.when(to_block, unwanted).otherwise(ordinary), F.lit("."), one_of("domain", DOMAINS, pair))
    path = F.when(drawn("path", 3, pair) > 0, short).otherwise(deep)
    url = F.concat(one_of("scheme", ("http", "https"), pair), F.lit("://"), host, path)
    return spark.range(n).select(url.alias("url"), to_block.cast("double").alias("label"), F.when(to_block, stem).alias("stem"))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; null or no ``://``: empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; null or no ``://``: empty."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest of ``rules`` (host/path, verdict) that fits; null if none. As many branches as rules: a short list."""
    found = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: len(r[0])):
        domain, _, rest = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith("/" + rest)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def _gram_at(text: Column, mark: str, n: int):
    return lambda start: F.concat(F.lit(mark), F.substring(text, start, F.lit(n)))


def char_ngrams(host: Column, path: Column, sizes: tuple[int, ...] = (3, 4, 5)) -> Column:
    """Character n-grams of ``^host$`` and ``^path$``; those of the host carry an ``h``, those of the path a ``p``."""
    parts = []
    for mark, text in (("h", host), ("p", path)):
        framed = F.concat(F.lit("^"), text, F.lit("$"))
        for n in sizes:
            starts = F.when(F.length(framed) >= n, F.sequence(F.lit(1), F.length(framed) - (n - 1))).otherwise(F.array().cast("array<int>"))
            parts.append(F.transform(starts, _gram_at(framed, mark, n)))
    return F.concat(*parts)


def hashed(urls: DataFrame, features: int) -> DataFrame:
    with_grams = urls.withColumn("_grams", char_ngrams(F.col("_host"), F.col("_path")))
    return HashingTF(numFeatures=features, binary=True, inputCol="_grams", outputCol="_features").transform(with_grams)


def train(labelled: DataFrame, *, features: int = 1 << 14, penalty: float = 0.01, iterations: int = 40) -> LogisticRegressionModel | None:
    """Fit on ``labelled`` (url, label); at most MOST_LABELS rows, a small table by contract. None without rows.

    Rows with a null label are not used; a null url counts as one without host and path.
    """
    known = labelled.where(F.col("label").isNotNull())
    n = known.count()
    if n > MOST_LABELS:
        raise ValueError(f"the labelled table holds more than {MOST_LABELS} rows")
    if not n:
        return None
    urls = known.select(F.col("label").cast("double"), host_of(F.col("url")).alias("_host"), path_of(F.col("url")).alias("_path")).coalesce(1)
    fit = LogisticRegression(featuresCol="_features", labelCol="label", regParam=penalty, maxIter=iterations, standardization=False)
    return fit.fit(hashed(urls, features))


def filter_urls(
    pages: DataFrame, rules: list[tuple[str, str]], model: LogisticRegressionModel | None, *, url_col: str = "url", threshold: float = 0.5
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (null if none fits), ``block_score`` (0 to 1) and ``verdict``.

    A null url or one without ``://`` has an empty host and path, fits no rule, and is judged by the model as such. Of
    rules that fit the longest wins; of equally long ones the later. Very long urls are read whole. Without a model what
    no rule fits is allowed, with a null score. Repeated rows are judged alike; an empty table gives no rows. Columns of
    the same names are replaced; others, whatever their names, stay as they are.
    """
    own = ["host", "path", "rule", "block_score", "verdict"]
    row, url = F.struct(*(F.col(f"`{c}`") for c in pages.columns)).alias("_row"), F.col(f"`{url_col}`")
    scored = pages.select(row, host_of(url).alias("_host"), path_of(url).alias("_path"))
    score = F.lit(None).cast("double")
    if model is not None:
        scored, score = model.transform(hashed(scored, model.numFeatures)), vector_to_array("probability")[1]
    rest = [F.col("_row")[c].alias(c) for c in pages.columns if c not in own]
    rule = rule_for(F.col("_host"), F.col("_path"), rules)
    verdicts = F.create_map(*(F.lit(x) for r in rules for x in r)) if rules else F.create_map().cast("map<string,string>")
    judged = F.coalesce(F.try_element_at(verdicts, rule), F.when(score >= threshold, "block").otherwise("allow"))
    return scored.select(*rest, F.col("_host").alias("host"), F.col("_path").alias("path"), rule.alias("rule"), score.alias("block_score"), judged.alias("verdict"))
