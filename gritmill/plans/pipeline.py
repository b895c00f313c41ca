"""Running named steps in order in one session, and the standard funnel."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import dedupe, lexicon, merge, sidetables
from ..schemas import EXCLUDED_KEYWORDS
from ..sources.writers import write_stage

Step = tuple[str, Callable[[SparkSession, dict[str, DataFrame]], DataFrame]]


class StepFailed(RuntimeError):
    pass


def run(spark: SparkSession, steps: list[Step], tables: dict[str, DataFrame], directory: str | None = None, if_exists: str = "overwrite") -> dict[str, DataFrame]:
    """Each step makes the table of its name from those before; the first failure ends the run.

    With a directory every table is written and read again, else plans are composed lazily.
    """
    out = dict(tables)
    for name, step in steps:
        try:
            df = step(spark, out)
            out[name] = write_stage(df, f"{directory}/{name}", if_exists) if directory else df
        except Exception as e:
            raise StepFailed(f"step {name} failed: {e}") from e
    return out


def funnel(spec: lexicon.LexiconSpec = lexicon.PLAIN, preset: str = "basic") -> list[Step]:
    """items, keywords, conversions and results to a classified table."""
    kw = lambda t: sidetables.clean_keywords(t["keywords"]).withColumns({"conf": sidetables.confidence("ai_service_1_confidence", "ai_service_2_confidence"), "user": sidetables.is_yes(t["keywords"]["suggested_by_user"])}).select("item_id", "kw", "conf", "user")
    return [
        ("excluded", lambda s, t: dedupe.excluded_ids(t["keywords"], EXCLUDED_KEYWORDS)),
        ("kept", lambda s, t: dedupe.exclude_by_keys(t["items"], t["excluded"], "item_id")),
        ("keywords_agg", lambda s, t: sidetables.keyword_agg(kw(t))),
        ("conversions_agg", lambda s, t: sidetables.conversion_agg(sidetables.clean_keywords(t["conversions"], 3, 80, require_letter=True).select("item_id", "kw"))),
        ("enriched", lambda s, t: sidetables.enrich(t["kept"], t["keywords_agg"], t["conversions_agg"])),
        ("preclassified", lambda s, t: lexicon.score_lexicon(t["enriched"], spec)),
        ("classified", lambda s, t: merge.merge_decisions(t["preclassified"], t["results"], preset)),
    ]
