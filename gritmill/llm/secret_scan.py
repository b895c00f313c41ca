"""Secret scans: multipart credential linking.

Strong spans (assignments, access identifiers, long hex strings) are reported as
they are. Weak candidates, a bare secret-like string or an endpoint, are
reported only when an interval join finds a part that complements them within
`scope` code points in the same text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import pick, read, row_key, table

#: Kinds in the order in which they are listed, and their patterns.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
SECRET = r"(?<![A-Za-z0-9+/=_-])(?=[A-Za-z0-9+/]*[A-Z])(?=[A-Za-z0-9+/]*[a-z])(?=[A-Za-z0-9+/]*[0-9])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=_-])"
ENDPOINT = r"""https?://[^\x00-\x20"'<>|]+"""
KINDS = ("assign", "access", "hex", "secret", "endpoint")
STRONG = 3
#: Which kinds complete a weak candidate.
COMPLEMENTS = {"secret": ("access", "endpoint"), "endpoint": ("access", "secret", "assign")}


def _pieces(text: Column, pattern: str, group: int, least: int, maybe: Column) -> Column:
    """For each match from left to right: characters before it since the last one, its own, whether it counts."""
    before = F.split(text, pattern, -1)
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    rows = F.transform(whole, lambda m, i: F.struct(F.length(F.get(before, i)).alias("gap"), F.length(m).alias("own"), (F.length(F.get(value, i)) >= least).alias("ok")))
    return F.when(maybe & text.rlike(pattern), rows)


def find_secrets(docs: DataFrame, scope: int = 300, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans): one row per input row; spans are (start, kind_no, kind, end, linked) sorted by start and kind.

    Offsets are code points, the end is exclusive. Matches of a kind are
    leftmost and do not overlap; a match that is too short is dropped after it
    has taken its place. Null and empty texts have no spans. Equal rows get
    equal results; an empty table gives no rows. Only spans are shuffled, never
    texts; the interval join is a semi join on scope-wide bins, so no pairs are
    made however many parts stand close together.
    """
    docs = pick(docs, doc_id=id_col, text=text_col).withColumn("text", F.coalesce("text", F.lit("")))
    text = F.col("text")
    access, url = F.contains(text, F.lit("AKIA")), F.contains(text, F.lit("://"))
    scanned = table(
        docs.select(
            *row_key(F.col("doc_id"), text),
            _pieces(text, ASSIGN, 2, 6, F.lit(True)).alias("assign"),
            _pieces(text, ACCESS, 0, 20, access).alias("access"),
            _pieces(text, HEX, 0, 24, F.lit(True)).alias("hex"),
            _pieces(text, SECRET, 0, 40, access | url).alias("secret"),
            _pieces(text, ENDPOINT, 0, 1, url).alias("endpoint"),
        ),
        "secret-scan",
    )
    key = ["doc_id", "rk1", "rk2"]
    some = scanned.where(F.coalesce(*KINDS).isNotNull()).dropDuplicates(key)
    pieces = None
    for k, kind in enumerate(KINDS):
        one = some.select(*key, F.lit(k).alias("kind_no"), F.posexplode(kind).alias("nth", "piece"))
        pieces = one if pieces is None else pieces.unionByName(one)
    w = _running(key)
    end = F.sum(F.col("piece.gap") + F.col("piece.own")).over(w).cast("long")
    spans = pieces.select(*key, "kind_no", (end - F.col("piece.own")).alias("start"), end.alias("end"), F.col("piece.ok").alias("ok")).where("ok").drop("ok")
    spans = table(spans, "secret-spans")
    linked = link_parts(spans, key, scope)
    kinds = F.array(*map(F.lit, KINDS))
    spans = spans.where(F.col("kind_no") < STRONG).withColumn("linked", F.lit(False)).unionByName(linked.withColumn("linked", F.lit(True)))
    one = F.struct("start", "kind_no", F.get(kinds, F.col("kind_no")).alias("kind"), "end", "linked")
    per = spans.groupBy(*key).agg(F.sort_array(F.collect_list(one)).alias("spans")).toDF("doc_id2", "rk12", "rk22", "spans")
    out = scanned.select(*key).join(per, F.col("doc_id").eqNullSafe(F.col("doc_id2")) & (F.col("rk1") == F.col("rk12")) & (F.col("rk2") == F.col("rk22")), "left")
    return out.select("doc_id", F.coalesce("spans", F.array().cast("array<struct<start:bigint,kind_no:int,kind:string,end:bigint,linked:boolean>>")).alias("spans"))


def _running(key):
    return W.partitionBy(*key, "kind_no").orderBy("nth").rowsBetween(W.unboundedPreceding, 0)


def link_parts(spans: DataFrame, key: list[str], scope: int) -> DataFrame:
    """The weak spans that have a complementary part within scope and lie in no strong span."""
    number = {k: i for i, k in enumerate(KINDS)}
    out = None
    for weak, parts in COMPLEMENTS.items():
        mine = spans.where(F.col("kind_no") == number[weak])
        near = lambda d: F.col("o_start") < F.col("end") + d
        other = spans.select(*(F.col(c).alias(f"o_{c}") for c in spans.columns))
        # Every bin that the other span, widened by the scope, touches; spans wider than a bin touch several.
        bins = F.explode(F.sequence(F.floor((F.greatest(F.col("o_start") - scope, F.lit(0))) / scope), F.floor((F.col("o_end") + scope) / scope)))
        other = other.select("*", bins.alias("o_bin"))
        same = F.col("doc_id").eqNullSafe(F.col("o_doc_id")) & (F.col("rk1") == F.col("o_rk1")) & (F.col("rk2") == F.col("o_rk2")) & (F.col("bin") == F.col("o_bin"))
        mine = mine.withColumn("bin", F.floor(F.col("start") / scope))
        inside = (F.col("o_start") <= F.col("start")) & (F.col("end") <= F.col("o_end"))
        mine = mine.join(other.where(F.col("o_kind_no") < STRONG), same & inside, "left_anti")
        # Every bin that the weak span touches: it may begin before all bins of a part that is near its end.
        mine = mine.withColumn("bin", F.explode(F.sequence(F.floor(F.col("start") / scope), F.floor(F.col("end") / scope))))
        linked = mine.join(other.where(F.col("o_kind_no").isin([number[p] for p in parts])), same & near(scope) & (F.col("o_end") + scope > F.col("start")), "left_semi").drop("bin").distinct()
        out = linked if out is None else out.unionByName(linked)
    return out


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op5_secret_scan(spark, sf_dir):
    out = find_secrets(read(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: ~s["linked"])
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return out.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))
