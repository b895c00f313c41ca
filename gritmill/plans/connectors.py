"""Sources, sinks and calls as queries: each writes to the shared folder, reads back, and has SQL over the tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import text as T
from ..operators import dedupe, external, lexicon, merge, publish
from ..schemas import fields
from ..sources import readers, writers
from . import catalogue, pipeline
from .catalogue import _merged, _no_pause, _scored, _toxic, query, table

# --- scans


@query("SELECT o_orderkey, o_orderpriority, o_totalprice, CAST(NULL AS VARCHAR) AS note FROM orders")
def csv_shards(spark, d):
    """Two sets of shards whose headers differ in order and in a column, bound by name."""
    base, x = writers.scratch(spark, "shards"), table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    even = F.col("o_orderkey") % 2 == 0
    x.where(even).write.option("header", True).csv(f"{base}/a")
    x.where(~even).select("o_totalprice", "o_orderkey", "o_orderpriority").withColumn("more", F.lit("x")).write.option("header", True).option("compression", "gzip").csv(f"{base}/b")
    return readers.read_shards(spark, base, "*/part-*.csv*", fields("o_orderkey bigint, o_orderpriority string, o_totalprice double, note string"), multi_line=False)


@query("SELECT CASE WHEN event_id % 2 = 0 THEN 'even' ELSE 'odd' END AS folder, count(*) AS n FROM events GROUP BY 1")
def shard_provenance(spark, d):
    """One scan of all shards that still knows each row's file."""
    base, x = writers.scratch(spark, "provenance"), table(spark, d, "events").select("event_id", "event_type")
    names = {}
    for k, name in enumerate(("even", "odd")):
        x.where(F.col("event_id") % 2 == k).coalesce(1).write.option("header", True).csv(f"{base}/{name}")
        names[name] = [p.rsplit("/", 1)[1] for p in readers.list_paths(spark, f"{base}/{name}/part-*")]
    rows = readers.read_shards(spark, base, "*/part-*", fields("event_id bigint, event_type string"), provenance=True, multi_line=False)
    folder = F.when(F.col("source_file").isin(names["even"]), "even").when(F.col("source_file").isin(names["odd"]), "odd")
    return rows.groupBy(folder.alias("folder")).agg(F.count("*").alias("n"))


@query("SELECT event_id, event_type, value FROM events")
def jsonl_ledger(spark, d):
    """JSON lines with blank and broken lines between them."""
    base, x = writers.scratch(spark, "ledger"), table(spark, d, "events").select("event_id", "event_type", "value")
    writers.write_json(x, base)
    spark.createDataFrame([("{broken",), ("",), ("  ",), ('{"event_id": 1, "value"',)], "value string").coalesce(1).write.mode("append").text(base)
    return readers.read_ledger(spark, base, x.schema)


@query("SELECT count(*) FILTER (WHERE event_id % 10 = 0) AS broken, count(*) FILTER (WHERE event_id % 10 <> 0) AS whole FROM events")
def jsonl_corrupt_lines(spark, d):
    base, x = writers.scratch(spark, "corrupt"), table(spark, d, "events")
    line = F.to_json(F.struct("event_id", "event_type"))
    x.select(F.when(F.col("event_id") % 10 == 0, F.substring(line, 1, 9)).otherwise(line).alias("value")).write.text(base)
    rows = readers.read_ledger(spark, base, fields("event_id bigint, event_type string"), keep_corrupt=True).cache()
    return rows.agg(F.count("_corrupt").alias("broken"), F.count_if(F.col("_corrupt").isNull()).alias("whole"))


@query("SELECT doc_id, lang, CAST(NULL AS VARCHAR) AS keywords_joined FROM documents")
def input_fallback(spark, d):
    """The enriched table if it exists, else the plain one with the columns it lacks as nulls."""
    from ..schemas import with_missing_columns

    x = readers.read_first(spark, writers.scratch(spark, "no-enriched-table"), f"{d}/documents.parquet")
    return with_missing_columns(x, StructType.fromDDL("keywords_joined string")).select("doc_id", "lang", "keywords_joined")


def _id_files(spark, d):
    """A file of ids for each language: (lang, id, file)."""
    base = writers.scratch(spark, "ids")
    writers.write_id_lists(table(spark, d, "documents").coalesce(1), base, by="lang", key="doc_id", distinct=True)
    rows = spark.read.text(base).select(F.col("category").alias("lang"), F.col("value").alias("id"), F.regexp_replace("_metadata.file_path", "^file:/*", "/").alias("file"))
    return base, rows


@query("SELECT DISTINCT lang, CAST(doc_id AS VARCHAR) AS id FROM documents WHERE lang <> 'de'")
def id_lists_of_existing_files(spark, d):
    """Id lists a language, read back where their file exists; one language points to a missing file."""
    base, rows = _id_files(spark, d)
    rows = rows.withColumn("file", F.when(F.col("lang") == "de", F.lit("/none")).otherwise(F.col("file")))
    return readers.existing_files(rows, "file", readers.file_listing(spark, base, "part-*")).select("lang", "id")


# --- sinks


@query(f"{catalogue.SCORED} SELECT 'all' AS route, count(*) AS n, count(DISTINCT doc_id) AS docs FROM scored UNION ALL SELECT CASE WHEN NOT rule_gate_pass THEN 'rejected' WHEN needs_llm THEN 'need_llm' ELSE 'direct' END, count(*), count(DISTINCT doc_id) FROM scored GROUP BY 1")
def routed_write(spark, d):
    """Scores written once, by route; every route is read from there."""
    out = writers.write_routes(_scored(spark, d), lexicon.route_name(), lexicon.ROUTES, writers.scratch(spark, "routes"))
    counts = [df.select(F.lit(name).alias("route"), "doc_id") for name, df in out.items()]
    whole = counts[0]
    for x in counts[1:]:
        whole = whole.unionByName(x)
    return whole.groupBy("route").agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("docs"))


@query("SELECT doc_id, n_chars, CAST(NULL AS VARCHAR) AS note FROM documents WHERE lang = 'en'")
def stage_overwrite_reuse(spark, d):
    """A stage with a pinned schema: written, overwritten with a warning, and kept by a later run that reuses it."""
    from ..schemas import conform

    path, schema = writers.scratch(spark, "stage"), fields("doc_id bigint, n_chars bigint, note string")
    x = conform(table(spark, d, "documents").select("doc_id", "n_chars", "lang"), schema)
    writers.write_stage(x, path)
    writers.write_stage(conform(table(spark, d, "documents").where("lang = 'en'"), schema), path)
    return writers.write_stage(x.limit(0), path, "reuse")


@query("SELECT lang AS category, count(*) AS n FROM documents GROUP BY 1")
def csv_report(spark, d):
    """A report with a byte order mark, read back by name."""
    path = writers.scratch(spark, "report")
    writers.write_csv(merge.group_counts(table(spark, d, "documents").withColumnRenamed("lang", "category"), "category").withColumnRenamed("count", "n"), path)
    return readers.read_shards(spark, path, "part-*", fields("category string, n bigint"))


@query("SELECT lang AS category, count(*) AS n FROM documents GROUP BY 1")
def json_array_report(spark, d):
    path = writers.scratch(spark, "array")
    writers.write_json(table(spark, d, "documents").groupBy(F.col("lang").alias("category")).agg(F.count("*").alias("n")), path, array=True)
    return spark.read.schema("category string, n bigint").option("multiLine", True).json(path)


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 2 ELSE 1 END AS runs, CASE WHEN event_id % 3 = 0 THEN 'r2' ELSE 'r1' END AS last FROM events")
def ledger_append(spark, d):
    """Two runs in one ledger; the later one speaks last."""
    path, x = writers.scratch(spark, "appended"), table(spark, d, "events").select("event_id")
    writers.append_ledger(x, path, "r1")
    writers.append_ledger(x.where("event_id % 3 = 0"), path, "r2")
    rows = spark.read.parquet(path)
    last = dedupe.latest_per_key(rows, "event_id", "run_id").select("event_id", F.col("run_id").alias("last"))
    return last.join(rows.groupBy("event_id").agg(F.count("*").alias("runs")), "event_id")


@query("SELECT conv_id, turn, role, text FROM conversations")
def jsonl_to_parquet(spark, d):
    path, x = writers.scratch(spark, "lines"), table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    writers.write_json(x, path)
    return writers.jsonl_to_parquet(spark, path, x.schema, f"{path}-parquet")


@query("SELECT doc_id, lang, source, 'bigint' AS doc_id_type FROM documents ORDER BY doc_id LIMIT 5")
def preview_rows(spark, d):
    """The first five rows, as a console shows them."""
    seen = writers.preview(table(spark, d, "documents").select("doc_id", "lang", "source").orderBy("doc_id"), 5)
    return spark.createDataFrame([(*(r[c] for c in seen["columns"]), seen["dtypes"]["doc_id"]) for r in seen["rows"]], "doc_id bigint, lang string, source string, doc_id_type string")


# --- downloads, files


class StubFetcher:
    """Stands in for the network: pages whose id ends in 7 are gone."""

    def fetch(self, url, relpath):
        if relpath.rstrip(".jpg").endswith("7"):
            raise OSError("gone")
        return {"status": 200, "size": len(url), "ext": ".jpg"}


@query("SELECT CAST(page_id AS VARCHAR) AS item_id, page_id % 10 <> 7 AS download_ok, CASE WHEN page_id % 10 = 7 THEN 'gone' ELSE '' END AS download_error, CASE WHEN page_id % 10 <> 7 THEN 200 END AS download_http_status, CASE WHEN page_id % 10 <> 7 THEN length(url) END AS file_size, CASE WHEN page_id % 10 = 7 THEN 3 ELSE 1 END AS download_attempts FROM pages")
def download_rows(spark, d):
    x = table(spark, d, "pages").select(F.col("page_id").cast("string").alias("item_id"), "url", F.concat(F.col("page_id").cast("string"), F.lit(".jpg")).alias("relpath"))
    out = external.download(x, StubFetcher(), url="url", sleep=_no_pause)
    return out.select("item_id", "download_ok", "download_error", "download_http_status", "file_size", "download_attempts")


@query("SELECT lang, lang <> 'de' AND lang <> 'fr' AS done FROM documents GROUP BY 1")
def cached_downloads(spark, d):
    """Done: a good ledger row and a file; one language's row is bad, another's file is missing."""
    base, rows = _id_files(spark, d)
    files = readers.file_listing(spark, base, "part-*")
    items = rows.groupBy(F.col("lang").alias("item_id")).agg(F.min("file").alias("local_image_path"))
    ledger = items.select("item_id", (F.col("item_id") != "de").alias("download_ok"), F.when(F.col("item_id") == "fr", F.lit("/none")).otherwise(F.col("local_image_path")).alias("local_image_path"))
    done, todo = publish.cached_split(items, ledger, files)
    return done.select(F.col("item_id").alias("lang"), F.lit(True).alias("done")).unionByName(todo.select(F.col("item_id").alias("lang"), F.lit(False).alias("done")))


@query("SELECT lang AS item_id, lang <> 'de' AS final_image_ok, CASE WHEN lang <> 'de' THEN 'images/' || lang || '/' || lang || '.txt' ELSE '' END AS final_image_relpath FROM documents GROUP BY 1")
def organised_files(spark, d):
    """Each language's id list copied to its place, with a status row; one source is missing."""
    base, rows = _id_files(spark, d)
    files = rows.groupBy(F.col("lang").alias("item_id")).agg(F.min("file").alias("local_image_path")).withColumn("final_label", F.col("item_id"))
    files = files.withColumn("local_image_path", F.when(F.col("item_id") == "de", "/none.txt").otherwise(F.col("local_image_path")))
    root = "/" + base.removeprefix("file:").lstrip("/") + "-organised"
    return publish.organise_files(files, root).select("item_id", "final_image_ok", "final_image_relpath")


@query("SELECT d.doc_id, d.lang, l.quality, CASE WHEN l.doc_id % 2 = 0 THEN 'keep' END AS review_action FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id")
def manifest_with_scores_and_review(spark, d):
    """The manifest with scores by id, then with reviews by id and class; a review of another class does not count."""
    items, scores = table(spark, d, "documents").select("doc_id", "lang"), table(spark, d, "labels").select("doc_id", "quality")
    kind = F.when(F.col("doc_id") % 2 == 0, F.col("lang")).otherwise("other")
    reviews = items.join(scores, "doc_id", "left_semi").select("doc_id", kind.alias("lang"), F.lit("keep").alias("review_action"))
    return publish.ledger_join(publish.ledger_join(items, scores, "doc_id", {}), reviews, ["doc_id", "lang"], {})


# --- model calls, selection, steps


@query("SELECT doc_id, 'source: ' || left(source, 1000) || chr(10) || 'lang: ' || lang || chr(10) || left(trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 600) AS prompt FROM documents")
def prompts(spark, d):
    x = table(spark, d, "documents")
    return x.select("doc_id", external.prompt_of(T.py_strip(F.col("text")), {"source": F.col("source"), "lang": F.col("lang")}).alias("prompt"))


class PromptReader:
    """Stands in for a model that answers from the prompt alone."""

    def classify(self, items):
        return [{"item_id": x["item_id"], "label": x["prompt"].split("\n")[0].removeprefix("lang: "), "confidence": 0.5} for x in items]


@query("SELECT count(*) AS n, count(*) AS different, bool_and(lang IS NOT NULL) AS answered FROM documents")
def arrival_sequence(spark, d):
    """Several calls in flight a task, from prompts; every row has a number of its own."""
    x = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("item_id"), "lang", "text")
    prompt = external.prompt_of(F.col("text"), {"lang": F.col("lang")})
    out = external.classify_external(x.withColumn("prompt", prompt).select("item_id", "prompt"), PromptReader(), in_flight=4, labels=catalogue.TEST_CLASSES, sleep=_no_pause)
    return out.agg(F.count("*").alias("n"), F.count_distinct("seq").alias("different"), F.every(F.col("llm_ok") & (F.length("llm_finished_at") == 19)).alias("answered"))


@query("SELECT vec_id, label % 3 <> 0 AS ok, CASE WHEN vec_id % 5 <> 0 THEN CAST(vec_id * 7 % 100 AS BIGINT) END AS score FROM embeddings")
def ok_score_sort(spark, d):
    """Good rows first, then by score, missing scores last; a test sees the order."""
    i = F.col("vec_id")
    x = table(spark, d, "embeddings").select("vec_id", (F.col("label") % 3 != 0).alias("ok"), F.when(i % 5 != 0, i * 7 % 100).alias("score"))
    return x.orderBy(F.col("ok").desc_nulls_last(), F.col("score").desc_nulls_last(), "vec_id")


@query(catalogue.QUOTA + f"SELECT doc_id, category AS category_final, category_confidence AS category_confidence_final, category_source AS category_source_final, NOT coalesce({catalogue.ELIGIBLE}, false) AS review_flag FROM merged")
def compatibility_columns(spark, d):
    return _merged(spark, d, "quota").select("doc_id", "category_final", "category_confidence_final", "category_source_final", "review_flag")


@query("SELECT count(*) AS n, true AS iso FROM labels")
def iso_timestamps(spark, d):
    return table(spark, d, "labels").withColumn("t", T.iso_now()).agg(F.count("*").alias("n"), F.every(F.col("t").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d$")).alias("iso"))


@query("SELECT lang AS category, count(*) AS n FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND toxic = 1) GROUP BY 1")
def steps_in_order(spark, d):
    """Three steps, each written and read by the next."""
    steps = [
        ("excluded", lambda s, t: _toxic(s, d)),
        ("kept", lambda s, t: dedupe.exclude_by_keys(t["documents"], t["excluded"], "doc_id")),
        ("counts", lambda s, t: t["kept"].groupBy(F.col("lang").alias("category")).agg(F.count("*").alias("n"))),
    ]
    return pipeline.run(spark, steps, {"documents": table(spark, d, "documents").select("doc_id", "lang")}, writers.scratch(spark, "steps"))["counts"]
