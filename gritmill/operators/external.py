"""Calls that leave the cluster: classifiers and downloads, with retry, bisection and status rows.

The caller injects an object; nothing here knows an address. Calls happen in
mapInPandas, so the number of partitions bounds how many run at a time.
Speculative execution must be off for these stages; sinks key rows by id.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clamp, round_half_even, safe
from ..schemas import LABELS

#: Fixed value: the label by which a model refuses.
REJECT_LABEL = "拒绝"


class Classifier(Protocol):
    def classify(self, items: list[dict]) -> list[dict]:
        """For each item its id, label, confidence and perhaps reason and is_target."""


class Fetcher(Protocol):
    def fetch(self, url: str, relpath: str) -> dict:
        """Stores a resource; status, content type and size."""


@dataclass(frozen=True)
class RetryPolicy:
    """attempt n is followed by a pause of min(longest, n * step) seconds."""

    retries: int = 3
    step: float = 1.2
    longest: float = 5.0

    def pause(self, attempt: int) -> float:
        return min(self.longest, attempt * self.step)


def prompt_of(text: Column, hints: dict[str, Column] | None = None, max_chars: int = 600, max_hint: int = 1000) -> Column:
    """The item's part of a prompt: its text, cut, and hints as 'name: value' lines."""
    lines = [F.concat(F.lit(f"{k}: "), F.substring(safe(v), 1, max_hint)) for k, v in (hints or {}).items()]
    return F.concat_ws("\n", *lines, F.substring(F.trim(safe(text)), 1, max_chars))


def check_answers(items: list[dict], answers: list[dict], labels: tuple[str, ...], strict: bool) -> list[dict]:
    """Answers in item order; unknown ids and labels are dropped, and an item without an answer is an error.

    strict: an unknown label is an error, the reject label and is_target false mean out of scope.
    """
    wanted, got = {str(x["item_id"]) for x in items}, {}
    for a in answers:
        key, label = str(a.get("item_id")), a.get("label")
        if key not in wanted:
            continue
        refused = strict and (not a.get("is_target", True) or label == REJECT_LABEL)
        if label not in labels and not refused:
            if strict:
                raise ValueError(f"unknown label: {label}")
            continue
        reason = str(a.get("reason") or "").strip()
        got[key] = {
            "item_id": key, "llm_label": None if refused else label, "llm_confidence": round(max(0.0, min(1.0, float(a.get("confidence") or 0.0))), 3), "llm_reason": reason,
            "llm_ok": True, "llm_error": "", "llm_in_scope": not refused, "llm_reject_reason": (reason or "llm_reject") if refused else "",
        }
    missing = [str(x["item_id"]) for x in items if str(x["item_id"]) not in got]
    if missing:
        raise ValueError(f"{len(missing)} items without an answer: {missing[:5]}")
    return [got[str(x["item_id"])] for x in items]


def call_with_retry(items: list[dict], call: Callable[[list[dict]], list[dict]], policy: RetryPolicy, bisect: bool, sleep=time.sleep) -> list[dict]:
    """call(items); after the last failure halves of the batch in turn, down to a failure row for a single item."""
    error = "unknown_error"
    for attempt in range(1, policy.retries + 1):
        try:
            return call(items)
        except Exception as e:  # noqa: BLE001  any failure of a remote call is a row, not a crash
            error = str(e) or error
            sleep(policy.pause(attempt))
    if len(items) == 1 or not bisect:
        return [{"item_id": str(x["item_id"]), "llm_label": None, "llm_confidence": 0.0, "llm_reason": "", "llm_ok": False, "llm_error": error[:1000], "llm_in_scope": False, "llm_reject_reason": "llm_call_failed"} for x in items]
    half = len(items) // 2
    return [r for part in (items[:half], items[half:]) for r in call_with_retry(part, call, policy, bisect, sleep)]


RESULT = "item_id string, llm_label string, llm_confidence double, llm_reason string, llm_ok boolean, llm_error string, llm_in_scope boolean, llm_reject_reason string, llm_called boolean, llm_finished_at string, seq bigint"


def classify_external(pending: DataFrame, classifier: Classifier, batch: int = 16, policy: RetryPolicy = RetryPolicy(), bisect: bool = True, labels: tuple[str, ...] = LABELS, strict: bool = False, concurrency: int | None = None, in_flight: int = 1, prompt: Column | None = None, sleep=time.sleep) -> DataFrame:
    """pending(item_id, text, ...) to one result row an item; seq orders the rows of one run.

    batch=1 with strict=True is the careful form, larger batches with bisect the
    fast one. concurrency limits partitions, in_flight the calls that one of
    them has open at a time. With prompt, items carry it as 'prompt'.
    """
    source = pending if concurrency is None else pending.repartition(concurrency)
    base = source.withColumn("__seq", F.monotonically_increasing_id())
    base = base if prompt is None else base.withColumn("prompt", prompt)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def answer(items: list[dict]) -> pd.DataFrame:
            out = call_with_retry(items, lambda xs: check_answers(xs, classifier.classify(xs), labels, strict), policy, bisect, sleep)
            now = datetime.now().isoformat(timespec="seconds")
            return pd.DataFrame([r | {"llm_called": True, "llm_finished_at": now, "seq": x["__seq"]} for r, x in zip(out, items, strict=True)])

        with ThreadPoolExecutor(in_flight) as pool:
            for frame in frames:
                rows = frame.to_dict("records")
                yield from pool.map(answer, (rows[at : at + batch] for at in range(0, len(rows), batch)))

    return base.mapInPandas(run, RESULT)


def validate_response(raw: Column, labels: tuple[str, ...] = LABELS) -> Column:
    """One model response in JSON as a struct (label, confidence, reason, in_scope, reject_reason, error), native."""
    parsed = F.from_json(raw, "is_target boolean, label string, confidence double, reason string")
    return F.get(F.transform(F.array(parsed), lambda x: _validated(x, labels)), F.lit(0))  # parsed once, named many times


def _validated(x: Column, labels: tuple[str, ...]) -> Column:
    label, reason = F.trim(safe(x["label"])), F.trim(safe(x["reason"]))
    refused = ~F.coalesce(x["is_target"], F.lit(False)) | (label == REJECT_LABEL)
    bad = x.isNull() | ~label.isin(*labels, REJECT_LABEL)
    sure = round_half_even(clamp(F.coalesce(x["confidence"], F.lit(0.0))), 3)
    return F.struct(
        F.when(~bad & ~refused, label).alias("label"), F.when(~bad, sure).alias("confidence"), F.when(~bad, reason).alias("reason"),
        (~bad & ~refused).alias("in_scope"), F.when(~bad & refused, F.coalesce(F.nullif(reason, F.lit("")), F.lit("llm_reject"))).alias("reject_reason"),
        F.when(bad, F.concat(F.lit("unknown label: "), label)).alias("error"),
    )


DOWNLOAD = "item_id string, download_ok boolean, download_error string, download_http_status bigint, local_image_relpath string, local_image_path string, file_size bigint, image_ext string, downloaded_at string, download_attempts bigint, from_cache boolean"


def download(items: DataFrame, fetcher: Fetcher, url: str = "photo_image_url", policy: RetryPolicy = RetryPolicy(), concurrency: int | None = None, sleep=time.sleep) -> DataFrame:
    """items(item_id, url, relpath) to one status row an item; failures are rows too."""
    source = items if concurrency is None else items.repartition(concurrency)

    def one(row: dict) -> dict:
        error, attempt = "", 0
        for attempt in range(1, policy.retries + 1):
            try:
                got = fetcher.fetch(row[url], row["relpath"])
                return {"download_ok": True, "download_error": "", "download_http_status": got.get("status"), "local_image_relpath": row["relpath"], "local_image_path": got.get("path", row["relpath"]), "file_size": got.get("size"), "image_ext": got.get("ext", ""), "download_attempts": attempt}
            except Exception as e:  # noqa: BLE001
                error = str(e)[:1000]
                sleep(policy.pause(attempt))
        return {"download_ok": False, "download_error": error, "download_http_status": None, "local_image_relpath": "", "local_image_path": "", "file_size": None, "image_ext": "", "download_attempts": attempt}

    def run(frames):
        for frame in frames:
            rows = [one(r) | {"item_id": str(r["item_id"]), "downloaded_at": datetime.now().isoformat(timespec="seconds"), "from_cache": False} for r in frame.to_dict("records")]
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in DOWNLOAD.split(", ")])
            yield out.astype({"download_http_status": "Int64", "file_size": "Int64"})

    return source.mapInPandas(run, DOWNLOAD)
