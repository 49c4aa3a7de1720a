"""What payloads hold, what of it is confirmed, and what is still open.

A payload's documents are named by a section and a key. A key is confirmed in a payload if results of that payload have
it; else it is superseded if a later payload holds it too, or open. A payload is done when none of its keys is open.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SENT = "section string, key string"


def key_text(parts: dict[str, Column]) -> Column:
    """The parts of a key as one text, in the order of their names; null parts are empty."""
    return F.concat_ws("&", *(F.concat(F.lit(f"{name}="), F.coalesce(F.trim(parts[name].cast("string")), F.lit(""))) for name in sorted(parts)))


def states(sent: DataFrame, confirmed: DataFrame) -> DataFrame:
    """payload, section, key and state of what was ``sent``, given what was ``confirmed`` (payload, section, key).

    Payloads are ordered by their names. What no payload holds is not confirmed by any result.
    """
    columns = ["payload", "section", "key"]
    both = sent.select(*columns, F.lit(True).alias("_sent")).unionByName(confirmed.select(*columns, F.lit(False).alias("_sent")))
    # one exchange by section and key serves both the grouping and the window
    marked = both.repartition("section", "key").groupBy(*columns).agg(F.max("_sent").alias("_sent"), F.min("_sent").alias("_only")).where("_sent")
    last = F.max("payload").over(Window.partitionBy("section", "key"))
    state = F.when(~F.col("_only"), "confirmed").when(F.col("payload") < last, "superseded").otherwise("open")
    return marked.select(*columns, state.alias("state"))


def unconfirmed(sent: DataFrame, confirmed: DataFrame) -> DataFrame:
    """section and key of what one payload holds and its results lack."""
    return sent.select("section", "key").join(confirmed.select("section", "key"), ["section", "key"], "left_anti")
