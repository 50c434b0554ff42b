"""Secret scan: base patterns, plus weak credential parts that only count together.

A text is scanned once, by native expressions. Splitting it at a pattern gives the
pieces between the matches; the running lengths of pieces and matches are the
matches' places in code points. From there on only the matches travel.

Parts play roles: identifiers (``access``, weak ``user``), secrets (``assign``,
``hex``, weak ``key``) and ``endpoint``. Weak parts are reported only when
complementary parts co-occur within a scope: a user with a secret, a key with an
identifier, an endpoint with both. Scopes are found by interval joins: spans are
dealt to cells of fixed width of their document, joined on (row, cell), and the
exact distance is tested. Matches of a kind don't overlap, so a cell holds a
bounded number of them and no document makes all its pairs.

Defined cases: a null text is empty; a null doc_id is kept; each input row gives
one row, repeated rows too; other columns are ignored; an empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialise, texts

_ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""

#: kind, pattern, role, always reported. Runs of one class are maximal, so a least
#: length inside the pattern is the same as dropping short matches afterwards.
KINDS = [
    ("assign", _ASSIGN, "secret", True),
    ("access", r"AKIA[A-Z0-9]{16,}", "identifier", True),
    ("hex", r"[0-9a-f]{24,}", "secret", True),
    ("user", r"""(?i:user(?:name)?|login|account|client_?id|access_?key_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{3,}""",
     "identifier", False),
    ("key", r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{32,}={0,2}", "secret", False),
    ("endpoint", r"""(?:https?|s3|ftp|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\x20\x09-\x0D"'<>]+""", "endpoint", False),
]
#: A value after an assignment has so many characters at least.
ASSIGN_VALUE = 6
#: Parts belong together when at most so many code points lie between them.
REACH = 160


def _matches(kind: str, pattern: str) -> Column:
    """All matches of one kind, each with the length of the piece before it; a last entry holds the rest of the text."""
    both = F.arrays_zip(F.regexp_extract_all("text", F.lit(pattern), F.lit(0)), F.split("text", pattern, -1))
    value = (lambda hit: F.length(F.regexp_extract(hit, pattern, 1)) >= ASSIGN_VALUE) if kind == "assign" else lambda hit: F.lit(True)
    return F.when(F.col("text").rlike(pattern), F.transform(both, lambda z, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("i"), F.length(z["1"]).alias("gap"), F.length(z["0"]).alias("size"), value(z["0"]).alias("ok"))))


def parts(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows (``row``, doc_id), and every match of every kind with its span; both from one scan."""
    found = F.flatten(F.array_compact(F.array(*(_matches(kind, pattern) for kind, pattern, *_ in KINDS))))
    seen = materialise(texts(docs).select(F.monotonically_increasing_id().alias("row"), "doc_id", found.alias("found")), "secrets")
    each = seen.select("row", F.explode("found").alias("m")).select("row", "m.*").filter("size IS NOT NULL")
    so_far = W.partitionBy("row", "kind").orderBy("i")
    spans = (each.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(so_far))
             .filter("ok").select("row", "kind", (F.col("end") - F.col("size")).alias("start"), "end"))
    rank = F.create_map(*(F.lit(x) for i, (kind, *_) in enumerate(KINDS) for x in (kind, i)))
    role = F.create_map(*(F.lit(x) for kind, _, role, _ in KINDS for x in (kind, role)))
    base = F.col("kind").isin([kind for kind, _, _, always in KINDS if always])
    spans = spans.select("*", rank[F.col("kind")].alias("rank"), role[F.col("kind")].alias("role"), base.alias("base"))
    return seen.select("row", "doc_id"), materialise(spans, "secret-spans")


def near(left: DataFrame, right: DataFrame, reach: int, how: str = "left_semi") -> DataFrame:
    """Rows of ``left`` with (or, for ``left_anti``, without) a span of ``right`` within ``reach``."""
    width = max(reach, 64)
    cell = lambda first, last: F.explode(F.sequence(F.floor(F.greatest(first, F.lit(0)) / width), F.floor(last / width))).alias("cell")
    there = right.select(F.col("row").alias("r_row"), F.col("start").alias("r_start"), F.col("end").alias("r_end"),
                         cell(F.col("start"), F.col("end"))).withColumnRenamed("cell", "r_cell")
    here = left.select("row", "start", "end", cell(F.col("start") - reach, F.col("end") + reach))
    met = here.join(there, (F.col("row") == F.col("r_row")) & (F.col("cell") == F.col("r_cell"))
                    & (F.col("r_start") <= F.col("end") + reach) & (F.col("start") <= F.col("r_end") + reach), "left_semi")
    return left.join(met.select("row", "start", "end").distinct(), ["row", "start", "end"], how)


def linked(spans: DataFrame, reach: int = REACH) -> DataFrame:
    """The weak parts whose complements co-occur within ``reach``."""
    base = spans.filter("base")
    # what a base span already covers is no part of its own; touching is no overlap
    covered = base.select("row", (F.col("start") + 1).alias("start"), (F.col("end") - 1).alias("end"))
    weak = near(spans.filter("NOT base"), covered, 0, "left_anti").select(*spans.columns)
    every = base.unionByName(weak)
    of = lambda role: every.filter(F.col("role") == role)
    key = near(weak.filter("role = 'secret'"), of("identifier"), reach)
    user = near(weak.filter("role = 'identifier'"), of("secret"), reach)
    endpoint = near(near(weak.filter("role = 'endpoint'"), of("secret"), reach), of("identifier"), reach)
    return key.unionByName(user).unionByName(endpoint).select(*spans.columns)


def scan(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """One row per input row: doc_id and ``spans``, an array of (start, rank, end, kind, base) in order."""
    rows, spans = parts(docs)
    told = spans.filter("base").unionByName(linked(spans, reach))
    by_row = told.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "rank", "end", "kind", "base"))).alias("spans"))
    return rows.join(by_row, "row", "left").select(
        "doc_id", F.coalesce("spans", F.array().cast(by_row.schema["spans"].dataType)).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """Counts and digests of :func:`scan`'s rows."""
    told = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(told(base), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"))
