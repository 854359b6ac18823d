"""Record tables: enrichment flags, type roll-ups and their distributions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelweave.functions.text import ASCII_SPELLINGS, contains_any, let, normalize_text, strip
from labelweave.operators.keyed import share_of_total

# Quality, safety and environment terms, and default column names.
QSE_TERMS = ("qualite", "securite", "environnement")
UNKNOWN_TYPE = "unknown"
DOMAIN_COLUMN = "domaine"
SUBDOMAIN_COLUMN = "sousdomaine"
TYPE_COLUMN = "typedeveille"


def plain_name(name: str) -> str:
    """Normalised form of a column name (driver side, names only)."""
    spelled = "".join(ASCII_SPELLINGS.get(c, c) for c in unicodedata.normalize("NFKC", name))
    bare = unicodedata.normalize("NFKD", spelled)
    return "".join(c for c in bare if not unicodedata.combining(c)).lower()


def resolve_column(df: DataFrame, want: str | int | None = None, normalized: bool = False) -> str:
    """A column by exact name, by normalised name, by position, or (None) the last."""
    names = df.columns
    if want is None:
        return names[-1]
    if isinstance(want, str) and not normalized and want in names:
        return want
    if isinstance(want, str) and normalized:
        for name in names:
            if plain_name(name) == want:
                return name
    elif isinstance(want, int) or str(want).lstrip("-").isdigit():
        position = int(want)
        if -len(names) <= position < len(names):
            return names[position]
    raise ValueError(f"column {want!r} not found among {names}")


def extract_is_match(col: Column | str) -> Column:
    """Match flag of an enrichment cell.

    A JSON object answers by the truthiness of ``isMatch``; anything else by
    an unquoted ``isMatch: true|false`` in the text; otherwise false.
    """
    c = F.col(col) if isinstance(col, str) else col
    by_text = F.lower(F.regexp_extract(c, r"(?i)isMatch\s*:\s*(true|false)", 1)) == "true"

    def truthy(value: Column) -> Column:
        falsy = value.isin("null", "false", '""', "[]", "{}") | F.coalesce(value.try_cast("double") == 0, F.lit(False))
        return F.coalesce(~falsy, F.lit(False))

    # one parse: the reader takes the last of repeated keys, knows NaN, and says whether the text is sound
    parsed = F.from_json(c, "isMatch VARIANT, _unsound STRING", {"columnNameOfCorruptRecord": "_unsound", "allowSingleQuotes": "false"})
    answer = let(parsed, lambda p: F.when(p["_unsound"].isNull(), truthy(F.to_json(p["isMatch"]))))
    bare = F.btrim(c, F.lit(" \t\r\n"))
    is_object = F.startswith(bare, F.lit("{")) & F.endswith(bare, F.lit("}"))
    return F.when(c.isNull(), F.lit(False)).when(is_object, F.coalesce(answer, by_text)).otherwise(by_text)


def sort_by_match(records: DataFrame, enrichment: str | None = None, order: str | None = "row_id") -> DataFrame:
    """Records with ``isMatch``, matches first, input order within."""
    source = resolve_column(records.drop(order) if order else records, enrichment)
    flagged = records.withColumn("isMatch", extract_is_match(F.col(f"`{source}`")))
    return flagged.orderBy(F.desc("isMatch"), *([order] if order else []))


def qse_flag(*cols: Column | str, terms=QSE_TERMS) -> Column:
    """True when any normalised text contains one of the terms."""
    out = F.lit(False)
    for c in cols:
        out = out | contains_any(normalize_text(c, "empty"), terms)
    return out


def _typed(records: DataFrame, type_col: str, domain_col: str, subdomain_col: str, terms) -> DataFrame:
    raw = F.coalesce(F.col(type_col), F.lit(UNKNOWN_TYPE))
    typed = records.select(
        "row_id", raw.alias("raw"), normalize_text(raw).alias("type_norm"),
        F.coalesce(domain_col, F.lit("")).alias("domain"), F.coalesce(subdomain_col, F.lit("")).alias("subdomain"),
        qse_flag(domain_col, subdomain_col, terms=terms).alias("qse"))
    return typed.where(strip(F.col("type_norm")) != "")


def _yes_no(flag: Column) -> Column:
    return F.when(flag, F.lit("Yes")).otherwise(F.lit("No"))


def distinct_types(records: DataFrame, type_col: str) -> DataFrame:
    return records.select(normalize_text(F.coalesce(F.col(type_col), F.lit(UNKNOWN_TYPE))).alias("type")).distinct()


def _combinations(records: DataFrame, type_col: str, domain_col: str, subdomain_col: str, terms) -> DataFrame:
    """Rows collapsed per (type, spelling, domain, subdomain) with counts; fixed-width sums, so a hash aggregate."""
    typed = _typed(records, type_col, domain_col, subdomain_col, terms)
    return typed.groupBy("type_norm", "raw", "domain", "subdomain").agg(
        F.min("row_id").alias("first_row"), F.count(F.lit(1)).alias("n"), F.bool_or("qse").alias("qse"))


def type_summary(records: DataFrame, type_col: str, domain_col: str, subdomain_col: str,
                 terms=QSE_TERMS, with_first: bool = False) -> DataFrame:
    """(Type, Count, QSE) per normalised type, largest first; shown as first written.

    *with_first* adds the first row of each type, the second part of the order.
    """
    summary = _combinations(records, type_col, domain_col, subdomain_col, terms).groupBy("type_norm").agg(
        F.min_by("raw", "first_row").alias("Type"), F.sum("n").alias("Count"),
        F.bool_or("qse").alias("_qse"), F.min("first_row").alias("first_row"))
    shown = summary.select("Type", "Count", _yes_no(F.col("_qse")).alias("QSE"), "first_row")
    return shown.orderBy(F.desc("Count"), "first_row") if with_first else shown.orderBy(
        F.desc("Count"), "first_row").drop("first_row")


def type_domain_pairs(records: DataFrame, type_col: str, domain_col: str, subdomain_col: str,
                      terms=QSE_TERMS) -> DataFrame:
    """Distinct (domain, subdomain) per type, in order of appearance, with the type's flag.

    Rows collapse per (type, domain, subdomain) before anything is joined; the
    per-type figures come from that reduced table.
    """
    combos = _combinations(records, type_col, domain_col, subdomain_col, terms).groupBy(
        "type_norm", "domain", "subdomain").agg(
        F.min_by("raw", "first_row").alias("raw"), F.min("first_row").alias("first_row"), F.bool_or("qse").alias("qse"))
    flags = combos.groupBy("type_norm").agg(
        F.min_by("raw", "first_row").alias("type"), F.bool_or("qse").alias("_qse"))
    return combos.select("type_norm", "domain", "subdomain", "first_row").join(flags, "type_norm").select(
        "type", "domain", "subdomain", _yes_no(F.col("_qse")).alias("QSE"), "first_row")


def top_summary(summary: DataFrame, n: int, count: str = "Count", name: str = "Type") -> DataFrame:
    return summary.orderBy(F.desc(count), name).limit(n)


def distribution(summary: DataFrame, n: int, count: str = "Count", name: str = "Type",
                 min_share: float | None = None) -> DataFrame:
    """Top *n* with their percentage of those n, and of everything.

    *min_share* keeps only rows above that fraction of the top-n total.
    """
    everything = summary.agg(F.sum(count).alias("_all"))
    top = share_of_total(top_summary(summary, n, count, name), count, "Percentage")
    out = top.crossJoin(F.broadcast(everything)).withColumn(  # one row
        "OverallPercentage", F.try_divide(F.col(count) * F.lit(100.0), F.col("_all"))).drop("_all")
    if min_share is not None:
        out = out.where(F.col("Percentage") > min_share * 100.0)
    return out.orderBy(F.desc(count), name)
