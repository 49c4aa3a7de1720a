"""Incremental runs over the purchasing data: units, suppliers, requests, orders, order lines, expenses, payments.

A step reads what changed since its cursor once, maps it to documents, decides what to do with them and writes payload
files, together with a ledger of what they hold, the links that their success would make and the cursor that it would
move. Results of the import come back through ``take_results``, for one payload: if they hold errors, nothing is kept;
else the links of what succeeded are saved, and once all that the payload holds is confirmed, the cursor moves to where
that payload ended, and no further. Payloads before it are superseded, as it holds what they held; later ones wait for
their own results. What is not confirmed is in the next payload again. Payloads of rows that were given to the run
(``arrived``) stand apart: none holds what another does, and each waits for its own results.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tributary.functions import exprs as E
from tributary.operators import documents, extracts, incremental, ledger, lookups, reconcile
from tributary.operators.state import KeyedStore, Manifest
from tributary.sources import payloads
from tributary.specs import DUPLICATE, ENTITIES, LINK_COLUMNS, LINK_KEYS, RESULT_SECTIONS, RUN_ORDER, UNIT_KINDS
from tributary.workspace import shuffles_removed, stored, temporary

LINK = "remote_id string, updated_at timestamp_ntz"
PENDING = "entity string, stamp string, last_id long, last_ts timestamp_ntz, records long, run_at timestamp_ntz, apart boolean"
ORDER_ACTIONS, FEED_ACTIONS = ("create", "resend", "same", "cancel", "register"), ("create", "update", "skip")


class Run:
    """Tables by name in, payload folders and state out.

    ``tables`` maps source table names to typed DataFrames; ``catalogs`` those of the target (``centros_costo``,
    ``tipos_factura``, ``tipos_retencion``: ordinal, id, name, codename, codigo, description). ``batch``: documents in an
    envelope, ``batches`` the same for single entities. ``limits``: rows that an entity takes at most in one run.
    ``force``: linked suppliers are updated instead of skipped by ``feed``. ``arrived``: changed rows of entities that are
    given instead of read by the cursor; ``stamp`` then names the run, and ``mark`` (a writer, a number) its writes of links,
    so that the same run again changes nothing. ``buckets``: those of link states.
    """

    def __init__(
        self, spark: SparkSession, tables: dict[str, DataFrame], folder: str, *, as_of: datetime.datetime, batch: int = 500, batches: dict[str, int] | None = None, dry_run: bool = False,
        catalogs: dict[str, DataFrame] | None = None, limits: dict[str, int] | None = None, force: bool = False, cancel_reason: str = "cancelled at the source", default_document_type: int | None = None,
        arrived: dict[str, DataFrame] | None = None, stamp: str | None = None, mark: tuple[str, int] | None = None, buckets: int = 64,
    ):
        self.spark, self.tables, self.folder, self.as_of, self.batch, self.dry_run = spark, tables, folder.rstrip("/"), as_of, batch, dry_run
        self.catalogs, self.limits, self.force, self.cancel_reason, self.default_document_type = catalogs or {}, limits or {}, force, cancel_reason, default_document_type
        self.batches, self.arrived, self.mark, self.buckets = batches or {}, arrived or {}, mark, buckets
        self.stamp, self.now = stamp or f"{as_of:%Y%m%d_%H%M%S}", F.lit(as_of).cast("timestamp_ntz")
        self.read: dict[str, DataFrame] = {}
        self.seen: dict[str, Manifest | None] = {}

    # State.

    def store(self, name: str) -> reconcile.StateStore:
        return reconcile.StateStore(self.spark, f"{self.folder}/state/{name}")

    def table(self, name: str, schema: str) -> DataFrame:
        found = self.store(name).read()
        empty = self.spark.createDataFrame([], schema)
        return empty if found is None else empty.unionByName(found, allowMissingColumns=True)

    def link_store(self, name: str) -> KeyedStore:
        return KeyedStore(self.spark, f"{self.folder}/state/link_{name}", _key(name), buckets=self.buckets)

    def links(self, name: str, keys: DataFrame | None = None) -> DataFrame:
        """The link state ``name``: its key columns, target id, time and columns of its own.

        With ``keys`` (the key columns), only the buckets that these fall into are read.
        """
        store = self.link_store(name)
        self.seen[name] = store.manifest()
        found = store.read(keys, self.seen[name]) if self.seen[name] else None
        empty = self.spark.createDataFrame([], f"{LINK_KEYS[name]}, {LINK}" + "".join(f", {c} string" for c in LINK_COLUMNS[name]))
        return empty if found is None else empty.unionByName(found, allowMissingColumns=True)

    def save_links(self, name: str, changes: DataFrame) -> None:
        """Add ``changes``; it is an error if another run has changed their buckets since this one read them last."""
        if not self.dry_run:
            self.link_store(name).write(changes, base=self.seen.get(name), mark=self.mark and (f"{self.mark[0]}/{name}", self.mark[1]))
            self.seen.pop(name, None)

    def state(self) -> DataFrame:
        return self.table("checkpoints", incremental.STATE)

    def pending(self) -> DataFrame:
        """Payloads whose results have not all come: where each would move its entity's cursor."""
        return self.table("pending", PENDING).fillna(False, ["apart"])

    def reset(self, entity: str | None = None) -> None:
        """The next run of ``entity``, or of all, is full; results of earlier payloads no longer move its cursor."""
        self.store("checkpoints").write(incremental.reset(self.state(), entity))
        self.store("pending").write(incremental.reset(self.pending(), entity))

    def report(self) -> DataFrame:
        """All entities with their state."""
        return incremental.status_report(self.spark.createDataFrame([(e,) for e in ENTITIES], "entity string"), self.state())

    # One step.

    @contextmanager
    def attempt(self, entity: str) -> Iterator[None]:
        """On an error the cursor stays and the error is kept; a dry run keeps nothing. No job leaves shuffle files."""
        try:
            with shuffles_removed(self.spark):
                yield
        except Exception as error:
            if not self.dry_run:
                self.store("checkpoints").write(incremental.failed(self.state(), entity, str(error)))
            raise

    def forget(self, before: datetime.datetime) -> int:
        """Remove what runs dated before ``before`` have written, but for state and pending payloads; how many folders went.

        Links of later results of those payloads then lack the columns of what was sent.
        """
        pending, gone = {r["stamp"] for r in self.pending().collect()}, 0
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        files = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        for depth in ("changed/*/*", "decided/*/*", "skipped/*/*", "payloads/*/*", "sent/*/*/*", "ledger/*/sent/*", "ledger/*/confirmed/*"):
            for found in files.globStatus(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{depth}")) or []:
                at = _time_of(found.getPath().getName())
                if at and at < before and found.getPath().getName() not in pending:
                    gone += bool(files.delete(found.getPath(), True))
        return gone

    def written(self, df: DataFrame, kind: str, name: str, stamp: str | None = None) -> DataFrame:
        """``df``, written for this run and read back: what is derived from it sees one state of a live source."""
        path = f"{self.folder}/{kind}/{name}/{stamp or self.stamp}"
        df.write.mode("overwrite").parquet(path, compression="zstd")
        return self.spark.read.schema(df.schema).parquet(path)

    def decided(self, docs: DataFrame, name: str, actions: tuple[str, ...]) -> tuple[DataFrame, dict[str, int]]:
        """``docs``, written with their ``action``, and how often each of ``actions`` occurs, counted by the same job.

        Counts are taken in the stage that writes, where a task that is tried again counts once.
        """
        seen = Observation()
        counted = docs.observe(seen, F.count(F.lit(1)).alias("all"), *(F.count_if(F.col("action") == a).alias(a) for a in actions))
        out = self.written(counted, "decided", name)
        return out, {a: n for a, n in seen.get.items() if n and a != "all"}

    def changed(self, entity: str) -> DataFrame:
        if entity not in self.read:
            spec = ENTITIES[entity]
            if entity in self.arrived:
                rows = self.arrived[entity]
            else:
                row = self.state().where(F.col("entity") == entity).first()
                rows = incremental.changed_rows(self.tables[spec.table], spec, row, self.now)
                if entity in self.limits:
                    rows = incremental.limited(rows, spec.id_column or spec.ts_column, spec.key, self.limits[entity])
            self.read[entity] = self.written(rows, "changed", entity)
        return self.read[entity]

    def step(self, entity: str, *parts: tuple[str, DataFrame, list[str]], links: dict[str, DataFrame] | None = None, needs_documents: bool = False) -> int:
        """Write payloads of the parts (section, documents, key) as gzipped lines, what they hold, and what their success would make of ``links``.

        A step with nothing to send moves the cursor at once. ``needs_documents``: changed rows that make no document
        are an error, unless in a dry run.
        """
        sent, names = 0, dict(RESULT_SECTIONS[entity])
        for section, docs, key in parts:
            seen = Observation()
            with temporary(self.spark):
                numbered = payloads.batch_numbers(docs, key, self.batches.get(entity, self.batch))
                out = payloads.envelopes(numbered, section, F.to_json(F.struct(*docs.columns)), dry_run=self.dry_run, options={"upsert": True})
                out = out.observe(seen, F.count(F.lit(1)).alias("batches"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
                out.select("payload").write.mode("overwrite").text(f"{self.folder}/payloads/{entity}/{self.stamp}/{section}", compression="gzip")
                if not self.dry_run:
                    held = ledger.key_text({k: F.col("external_id")[k] for k in _external_names(names[section])})
                    self.written(numbered.select(F.lit(section).alias("section"), held.alias("key")), "ledger", f"{entity}/sent/{self.stamp}", section)
            sent += seen.get.get("n", 0)
        seen = incremental.cursor_values(self.changed(entity), ENTITIES[entity])
        if self.dry_run:
            return sent
        runs = seen.select(F.lit(entity).alias("entity"), F.lit(self.stamp).alias("stamp"), "last_id", "last_ts", F.lit(sent).cast("long").alias("records"), self.now.alias("run_at"), F.lit(entity in self.arrived).alias("apart"), F.col("records").alias("_read"))
        if needs_documents and not sent and runs.first()["_read"]:
            raise RuntimeError(f"{entity}: no changed row makes a document")
        for name, rows in (links or {}).items():
            self.written(rows, "sent", f"{entity}/{name}")
        pending = self.pending()
        if sent:
            same = (F.col("entity") == entity) & (F.col("stamp") == self.stamp)
            self.store("pending").write(pending.where(~same).unionByName(runs.drop("_read")))
        else:
            self.store("pending").write(pending.where((F.col("entity") != entity) | F.col("apart")))
            self.store("checkpoints").write(incremental.succeeded(self.state(), runs.drop("_read", "stamp", "apart")))
        return sent

    # Results.

    def payload_of(self, entity: str, stamp: str | None = None) -> str | None:
        """The pending payload that results are for: the one named, else this run's, else the only one; None without any."""
        found = sorted(r["stamp"] for r in self.pending().where(F.col("entity") == entity).collect())
        if stamp:
            return stamp
        if self.stamp in found:
            return self.stamp
        if len(found) > 1:
            raise ValueError(f"{entity} has the payloads {', '.join(found)} pending: name the one that these results are for")
        return found[0] if found else None

    def sent(self, entity: str, stamp: str) -> DataFrame:
        """section and key of what a payload holds."""
        return self._ledger(entity, "sent", stamp)

    def confirmed(self, entity: str, stamp: str) -> DataFrame:
        """section and key of what results have confirmed of a payload."""
        return self._ledger(entity, "confirmed", stamp)

    def _ledger(self, entity: str, kind: str, stamp: str) -> DataFrame:
        path = f"{self.folder}/ledger/{entity}/{kind}/{stamp}"
        return self.spark.read.schema(ledger.SENT).parquet(f"{path}/*") if self._exists(path) else self.spark.createDataFrame([], ledger.SENT)

    def take_results(self, entity: str, results: DataFrame, *, stamp: str | None = None, directory: DataFrame | None = None) -> dict[str, int]:
        """Take in the import results (``body``: JSON) of a payload of ``entity``: links saved, by state.

        The payload is the pending one named by ``stamp``, see ``payload_of``. Rows of a result that the payload does not hold
        are left alone. Errors stop here: no link is saved and the cursor stays. Not so for suppliers that were rejected
        because they exist: with the target's ``directory`` (id, cuit) they are linked by their tax ids, and are no errors.
        Late results of a payload that is no longer pending save links as of that payload, and move nothing.
        """
        with self.attempt(entity):
            stamp = self.payload_of(entity, stamp)
            pending = self.pending()
            mine = pending.where((F.col("entity") == entity) & (F.col("stamp") == stamp)) if stamp else None
            found = {name: self._successes(entity, section, name, results, stamp) for section, name in RESULT_SECTIONS[entity]}
            recovered = 0
            if directory is not None and "proveedores" in found:
                again = self.written(self._existing(results, entity, stamp, directory), "results", f"{entity}/existing")
                recovered = again.count()
                found["proveedores"] = found["proveedores"].unionByName(again)
            errors = payloads.result_errors(results, "body")
            payloads.raise_on_errors(errors.withColumn("errors", F.col("errors") - F.when(F.col("section") == "proveedores", recovered).otherwise(0)))
            saved = {name: self._save(entity, section, name, found[name], stamp) for section, name in RESULT_SECTIONS[entity]}
            if mine is not None and not self.dry_run:
                if not ledger.unconfirmed(self.sent(entity, stamp), self.confirmed(entity, stamp)).limit(1).count() and mine.limit(1).count():
                    self.store("checkpoints").write(incremental.succeeded(self.state(), mine.drop("stamp", "apart")))
                    later = (F.col("stamp") > stamp) | (F.col("apart") & (F.col("stamp") != stamp))
                    self.store("pending").write(pending.where((F.col("entity") != entity) | later))
            return saved

    def _successes(self, entity: str, section: str, name: str, results: DataFrame, stamp: str | None) -> DataFrame:
        """external_id, id and ledger key of the results of a section that succeeded and, if known, that the payload holds."""
        found = payloads.import_results(results, "body", section).select("external_id", "id", _result_key(name).alias("key"))
        if stamp:
            own = self.sent(entity, stamp).where(F.col("section") == section).select("key")
            found = found.join(own, "key", "left_semi").select("external_id", "id", "key")
        return found

    def _existing(self, results: DataFrame, entity: str, stamp: str | None, directory: DataFrame) -> DataFrame:
        """As ``_successes``: suppliers rejected as duplicates whose tax id ``directory`` has."""
        field, words = DUPLICATE
        rejected = payloads.rejected_duplicates(results, "body", "proveedores", field, words).select("external_id", _result_key("proveedores").alias("key"))
        known = rejected.withColumn("COD_PROV", F.col("external_id")["cod_prov"].try_cast("int"))
        path = f"{self.folder}/sent/{entity}/proveedores/{stamp}"
        tax = self.spark.read.parquet(path) if stamp and self._exists(path) else self.links("proveedores")
        matched = lookups.match_by_digits(known.join(tax.select("COD_PROV", "cuit"), "COD_PROV"), "cuit", directory, "cuit", "id", "id")
        return matched.where("id IS NOT NULL").select("external_id", F.col("id").cast("string").alias("id"), "key")

    def _save(self, entity: str, section: str, name: str, found: DataFrame, stamp: str | None) -> int:
        """Save the links of ``found`` and confirm their keys; their other columns are those of what was sent, or else stay as they are."""
        key, kinds = _key(name), dict(x.split() for x in LINK_KEYS[name].split(", "))
        external, taken = F.col("external_id"), uuid.uuid4().hex
        found = self.written(found, "results", f"{entity}/{name}", taken)
        if name == "gasto":
            columns = {"ref": F.explode(lookups.expense_keys(*(external[c.lower()] for c in extracts.EXPENSE)))}
        else:
            columns = {k: external[k.lower()].try_cast(kinds[k]) for k in key}
        sent_at = self.now
        if stamp:
            row = self.pending().where((F.col("entity") == entity) & (F.col("stamp") == stamp)).first()
            sent_at = F.lit(row["run_at"] if row else _time_of(stamp) or self.as_of).cast("timestamp_ntz")
        links = found.select(F.col("id").alias("remote_id"), *(c.alias(k) for k, c in columns.items())).dropna(subset=key)
        links = links.groupBy(*key).agg(F.max("remote_id").alias("remote_id")).withColumn("updated_at", sent_at)
        own = list(LINK_COLUMNS[name])
        if own:
            rest = self.links(name, links.select(*key)).select(*key, *own)
            path = f"{self.folder}/sent/{entity}/{name}/{stamp}"
            if stamp and self._exists(path):
                sent = self.spark.read.parquet(path)
                rest = rest.join(sent.select(*key), key, "left_anti").unionByName(sent)
            links = links.join(rest, key, "left")
        seen = Observation()
        links = self.written(links.observe(seen, F.count(F.lit(1)).alias("n")), "links", f"{entity}/{name}", taken)
        self.save_links(name, links)
        if stamp and not self.dry_run:
            self.written(found.select(F.lit(section).alias("section"), "key"), "ledger", f"{entity}/confirmed/{stamp}", f"{name}-{taken}")
        return seen.get.get("n", 0)

    def _exists(self, path: str) -> bool:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(where)

    # The entities.

    def units(self) -> int:
        with self.attempt("jurisdicciones"):
            rows = documents.units(self.changed("jurisdicciones"))
            own = rows.withColumn("external_id", F.struct(F.col("code").alias("jurisdiccion")))
            return self.step("jurisdicciones", *((section, own.where(F.col("kind") == kind).drop("kind"), ["code"]) for kind, section in UNIT_KINDS))

    def _supplier_links(self, rows: DataFrame) -> DataFrame:
        state = F.col("COD_ESTADO") if "COD_ESTADO" in rows.columns else F.lit(None)
        return rows.dropna(subset=["COD_PROV"]).groupBy(F.col("COD_PROV").cast("int").alias("COD_PROV")).agg(F.max(E.digits_key("CUIT")).alias("cuit"), F.max(state.cast("string")).alias("cod_estado"))

    def suppliers(self) -> int:
        with self.attempt("proveedores"):
            rows = self.changed("proveedores")
            docs = documents.suppliers(rows).withColumn("cod_prov", F.col("external_id.cod_prov"))
            return self.step("proveedores", ("proveedores", docs, ["cod_prov"]), links={"proveedores": self._supplier_links(rows)})

    def feed(self) -> dict[str, int]:
        """Suppliers one by one: new ones are created, linked ones updated if forced, else skipped."""
        with self.attempt("proveedores"):
            rows = self.changed("proveedores")
            linked = self.links("proveedores").where("remote_id <> ''").select(F.col("COD_PROV").alias("cod_prov"), F.col("remote_id"))
            docs = documents.suppliers(rows).withColumn("cod_prov", F.col("external_id.cod_prov")).join(linked, "cod_prov", "left")
            action = reconcile.feed_action(F.col("remote_id").isNotNull(), F.lit(self.force))
            decided, counts = self.decided(docs.withColumn("action", action), "feed", FEED_ACTIONS)
            self.step("proveedores", ("proveedores", decided.where("action <> 'skip'"), ["cod_prov"]), links={"proveedores": self._supplier_links(rows)})
            return counts

    def link_existing(self, directory: DataFrame, tax: str = "cuit", ident: str = "id") -> int:
        """Link changed suppliers without a link to the target's ``directory`` by their tax ids."""
        own = self._supplier_links(self.changed("proveedores"))
        rows = own.join(self.links("proveedores", own).where("remote_id <> ''"), "COD_PROV", "left_anti")
        found = lookups.match_by_digits(rows, "cuit", directory, tax, ident, "remote_id").where("remote_id IS NOT NULL")
        found = self.written(found.withColumns({"remote_id": F.col("remote_id").cast("string"), "updated_at": self.now}), "results", "directory")
        self.save_links("proveedores", found)
        return found.count()

    def requests(self) -> int:
        with self.attempt("ped_items"):
            lines = extracts.request_line_extract(self.changed("ped_items"), self.tables["PEDIDOS"])
            docs = documents.request_documents(lines, self.unit_links()).withColumn("external_id", _external(extracts.REQUEST))
            return self.step("ped_items", ("pedidos", docs, extracts.REQUEST), needs_documents=True)

    def expenses(self) -> int:
        """Expenses that sent orders refer to."""
        with self.attempt("solic_gastos"):
            changed = self.changed("solic_gastos")
            lines = extracts.touched(self.tables["OC_ITEMS"], changed, {k: k for k in extracts.EXPENSE})
            rows = extracts.expense_extract(changed, lines, self.tables["ORDEN_COMPRA"])
            ref = E.expense_ref(*extracts.EXPENSE)
            rows = lookups.with_sent_refs(rows, ref, self.links("orden_compra"), "remote_id", "gasto_refs")
            types, kind = self.catalogs.get("tipos_factura"), None
            if types is not None:
                attempts = [(F.col("TIPO_DOC"), lookups.text_index(types, c)) for c in ("codename", "name")]
                rows, kind = lookups.resolve_text(rows, attempts, "_type", default=self.default_document_type), F.col("_type")
            docs = documents.expense_documents(rows, kind, self.unit_links(), self.links("proveedores").where("remote_id <> ''")).withColumn("external_id", _external(extracts.EXPENSE))
            own = rows.select(
                F.explode(lookups.expense_keys(*extracts.EXPENSE)).alias("ref"),
                E.status_code("ESTADO_SOLIC").alias("estado_solic"), F.col("IMPORTE_TOT").cast("string").alias("importe_tot"), F.col("OC_COD_PROV").cast("string").alias("cod_prov"),
            )
            return self.step("solic_gastos", ("gastos", docs, extracts.EXPENSE), links={"gasto": own})

    def payments(self) -> int:
        """Payments with a resolved expense, found by number or trace, else by the order settled; with withholdings."""
        with self.attempt("orden_pago"):
            rows = self.changed("orden_pago")
            lines, expenses = (extracts.touched(self.tables[t], rows, {"EJERCICIO": "EJERCICIO", "NRO_SOLIC": "NRO_CANCE"}) for t in ("OC_ITEMS", "SOLIC_GASTOS"))
            trace = extracts.trace_view(lines, expenses, self.tables["ORDEN_COMPRA"], self.tables.get("PEDIDOS"))
            direct = extracts.payment_refs(rows, expenses, trace)
            orders = self.links("orden_compra").select("EJERCICIO", "NRO_OC", E.split_list("gasto_refs").alias("refs"))
            links = self.links("gasto").where("remote_id <> ''")
            docs = documents.payment_documents(rows, direct, extracts.fallback_refs(rows, orders), links).withColumn("external_id", _external(extracts.PAYMENT))
            if self.tables.get("RETENCIONES") is not None:
                found = self.withholdings(rows)
                own = F.sort_array(F.collect_list(F.struct(*(c for c in found.columns if c not in extracts.PAYMENT)))).alias("retenciones")
                docs = docs.join(found.groupBy(*extracts.PAYMENT).agg(own), extracts.PAYMENT, "left")
            sent = rows.dropna(subset=extracts.PAYMENT).groupBy(*extracts.PAYMENT).agg(F.max(E.status_code("ESTADO_OP")).alias("estado_op"), F.max(F.col("IMPORTE_TOTAL").cast("string")).alias("importe_total"))
            return self.step("orden_pago", ("ordenes_pago", docs, extracts.PAYMENT), links={"orden_pago": sent})

    def withholdings(self, payments: DataFrame) -> DataFrame:
        """Withholdings of ``payments``, their types' ids by a link of the code, else from the catalog by code or name."""
        on = ["EJERCICIO", "NRO_CANCE"]
        held = documents.last_withholdings(self.tables["RETENCIONES"].withColumn("ordinal", F.struct("CUENTA", "IMPORTE")), payments, on)
        codes, types = self.tables.get("DEDUCCIONES"), self.catalogs.get("tipos_retencion")
        if codes is not None:
            held = held.join(codes.select(F.col("CODIGO").alias("COD_RET"), "DESCRIPCION").dropDuplicates(["COD_RET"]), "COD_RET", "left")
        else:
            held = held.withColumn("DESCRIPCION", F.lit(None).cast("string"))
        linked = self.links("tipo_retencion").select(F.col("COD_RET").alias("_code"), E.to_int("remote_id").alias("_linked"))
        held = held.join(linked, E.clean(F.col("COD_RET").cast("string")) == F.col("_code"), "left")
        attempts = [] if types is None else [(F.col("COD_RET").cast("string"), lookups.text_index(types, "codigo")), (F.col("COD_RET").cast("string"), lookups.text_index(types, "codename")), (F.col("DESCRIPCION"), lookups.text_index(types, "name"))]
        held = lookups.resolve_text(held, attempts, "_found") if attempts else held.withColumn("_found", F.lit(None).cast("int"))
        return documents.withholding_documents(payments, held.withColumn("tipo_impuesto_id", F.coalesce("_linked", "_found")), on)

    def unit_links(self) -> DataFrame:
        """JURISDICCION with the ids of its cost centre, rubro and classification.

        Cost centres that only the catalog knows, by the unit in their description, are linked from it first.
        """
        catalog = self.catalogs.get("centros_costo")
        if catalog is not None and not self.dry_run:
            known = self.links("centro_costo")
            rows = lookups.described_codes(catalog, documents.UNIT_TEXT).select(F.col("code").alias("JURISDICCION"), F.col("id").cast("string").alias("remote_id"), self.now.alias("updated_at"))
            rows = rows.where(E.to_int("remote_id").isNotNull())
            if rows.join(known.where("remote_id <> ''"), "JURISDICCION", "left_anti").limit(1).count():
                self.save_links("centro_costo", rows.join(known.where("remote_id <> ''"), "JURISDICCION", "left_anti"))
        out = self.tables["JURISDICCIONES"].select(E.clean("JURISDICCION").alias("JURISDICCION")).dropna().distinct()
        for name, _ in UNIT_KINDS:
            ids = self.links(name).select("JURISDICCION", E.to_int("remote_id").alias(f"{name}_id"))
            out = out.join(ids, "JURISDICCION", "left")
        return out

    def orders(self) -> dict[str, int]:
        """Send confirmed orders that are new or have newly resolved expenses, and cancel those sent; register the rest."""
        with self.attempt("orden_compra"):
            rows = self.changed("orden_compra")
            return self._orders("orden_compra", rows, rows, lambda orders: extracts.touched(self.tables["OC_ITEMS"], orders, {k: k for k in extracts.ORDER}))

    def order_lines(self) -> dict[str, int]:
        """As ``orders``, from the changed lines."""
        with self.attempt("oc_items"):
            rows = self.changed("oc_items")
            orders = extracts.touched(self.tables["ORDEN_COMPRA"], rows, {k: k for k in extracts.ORDER})
            return self._orders("oc_items", rows, orders, lambda orders: rows)

    def _orders(self, entity: str, rows: DataFrame, orders: DataFrame, lines: Callable[[DataFrame], DataFrame]) -> dict[str, int]:
        """``rows``: those changed; ``lines``: the lines to send, given their orders. Suppliers are found for orders, not for lines."""
        key = extracts.ORDER
        suppliers = self.links("proveedores").where("remote_id <> ''")
        named = lines(orders).select(*key).join(orders.select(*key, "COD_PROV"), key, "left")
        self.written(documents.skipped_orders(named, suppliers), "skipped", entity)
        state = self.links("orden_compra", rows)
        old = state.select(*key, F.col("estado_oc").alias("_previous"), F.col("remote_id").alias("_id"), F.col("gasto_ids").alias("_old_ids"))
        action = reconcile.order_action(F.col("OC_ESTADO_OC"), F.col("_previous"), F.col("_id"), F.col("_ids"), F.col("_old_ids"))
        with temporary(self.spark):  # lines are exchanged by order, by expense and by order: each time in a job of its own, whose files go
            known = stored(documents.with_suppliers(orders.select(*key, "COD_PROV", *extracts.HEADER), suppliers), "orders", compression="zstd")
            own = stored(lines(known).select(documents.ORDER_LINE), "lines", compression="zstd")
            found = extracts.with_header(known, stored(extracts.with_unit(own, self.tables["SOLIC_GASTOS"]), "units", compression="zstd"))
            docs = documents.order_documents(found, None, self.unit_links(), self.links("gasto").where("remote_id <> ''"))
            docs = docs.withColumns({"_refs": F.array_join("gasto_refs", ","), "_ids": F.array_join("gasto_ids", ",")})
            decided, counts = self.decided(docs.join(old, key, "left").withColumn("action", action), entity, ORDER_ACTIONS)
        links = decided.select(
            *key, F.nullif(E.date_only("OC_FECH_CONFIRM"), F.lit("")).alias("fech_confirm"), E.status_code("OC_ESTADO_OC").alias("estado_oc"), F.col("COD_PROV").cast("string").alias("cod_prov"),
            F.col("OC_IMPORTE_TOT").cast("string").alias("importe_tot"), F.col("_refs").alias("gasto_refs"), F.col("_ids").alias("gasto_ids"), "action", "_old_ids",
        )
        sent = F.col("action").isin("create", "resend", "cancel")
        cancelled = F.col("action") == "cancel"
        out = decided.where(sent).withColumns({"estado_aprobacion": F.when(cancelled, 4).otherwise(1), "motivo_rechazo": F.when(cancelled, F.lit(self.cancel_reason)), "external_id": _external(key)})
        self.step(entity, ("ordenes_compra", out.drop("_refs", "_ids", "_previous", "_id", "_old_ids"), key), links={"orden_compra": links.where(sent).drop("action", "_old_ids")})
        quiet = links.where(~sent).withColumn("gasto_ids", F.col("_old_ids")).drop("action", "_old_ids").withColumn("updated_at", self.now)
        self.save_links("orden_compra", reconcile.keep_target(quiet, state, key))
        return counts

    def all(self) -> None:
        """Every entity in the order of their dependencies; an entity's error does not stop the others."""
        steps = {"jurisdicciones": self.units, "proveedores": self.suppliers, "ped_items": self.requests, "orden_compra": self.orders, "solic_gastos": self.expenses, "orden_pago": self.payments}
        failed = {}
        for entity in RUN_ORDER:
            try:
                steps[entity]()
            except Exception as error:
                failed[entity] = error
        if failed:
            raise RuntimeError(f"failed: {', '.join(failed)}") from next(iter(failed.values()))


def _key(name: str) -> list[str]:
    return [x.split()[0] for x in LINK_KEYS[name].split(", ")]


def _external(key: list[str]) -> Column:
    return F.struct(*(F.col(c).alias(c.lower()) for c in key))


def _external_names(name: str) -> list[str]:
    """The parts of the external id that name a document of the link state ``name``."""
    return [k.lower() for k in (extracts.EXPENSE if name == "gasto" else _key(name))]


def _result_key(name: str) -> Column:
    return ledger.key_text({k: F.col("external_id")[k] for k in _external_names(name)})


def _time_of(stamp: str) -> datetime.datetime | None:
    try:
        return datetime.datetime.strptime(stamp, "%Y%m%d_%H%M%S")
    except ValueError:
        return None
