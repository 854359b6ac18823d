"""Summary of a rule catalogue held as nested rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelweave.functions.text import strip


def _attributes(attrs: Column) -> Column:
    return F.array_join(F.transform(
        F.map_entries(attrs), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ", ")


def _call(name: Column, attrs: Column) -> Column:
    """``name`` alone, or ``name(k=v, ...)`` when there are attributes."""
    return F.when(F.size(F.coalesce(attrs, F.create_map().cast("map<string,string>"))) > 0,
                  F.concat(name, F.lit("("), _attributes(attrs), F.lit(")"))).otherwise(name)


def summarize_rules(rules: DataFrame) -> DataFrame:
    """(id, priority, description, condition, action), by numeric priority (unreadable: 0).

    *rules*: id, priority, description, ``condition`` array of (tag, attrs
    map) in order, ``action`` map with a ``type`` entry.
    """
    condition = F.array_join(F.transform("condition", lambda c: _call(c["tag"], c["attrs"])), " & ")
    kind = strip(F.coalesce(F.try_element_at("action", F.lit("type")), F.lit("")))
    params = F.map_filter("action", lambda k, v: k != "type")
    text = lambda c: F.coalesce(strip(F.col(c)), F.lit(""))
    priority = F.coalesce(strip(F.col("priority")).try_cast("double").try_cast("int"), F.lit(0))
    return rules.select(
        text("id").alias("id"), priority.alias("priority"), text("description").alias("description"),
        F.coalesce(condition, F.lit("")).alias("condition"),
        F.when(F.col("action").isNull(), F.lit("")).otherwise(_call(kind, params)).alias("action"),
    ).orderBy("priority", "id")
