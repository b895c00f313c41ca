"""Text expressions; each returns a Column and stays inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python's \s has it, and as RE2's.
PY_SPACE = "[\\x09-\\x0D\\x1C-\\x20\\x85\\xA0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000]"
PY_SPACE_CHARS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
SQL_SPACE = "[\\t\\n\\f\\r ]"
NOT_WORD = r"[^\p{L}\p{N}_]+"


def safe(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def py_strip(c: Column) -> Column:
    """Looks at the ends only, where a pattern would go through the whole text."""
    return F.btrim(c, F.lit(PY_SPACE_CHARS))


def sql_trim(c: Column) -> Column:
    """Strips what Unicode calls space separators, tabs and line ends stay."""
    return F.regexp_replace(c, r"^\p{Zs}+|\p{Zs}+$", "")


def collapse(c: Column) -> Column:
    return F.regexp_replace(c, f"{SQL_SPACE}+", " ")


def norm_text(c: Column) -> Column:
    """Lower case; bars, underscores, slashes and white space become single spaces."""
    return F.trim(F.regexp_replace(F.lower(safe(c)), r"[|_/\\" + PY_SPACE[1:] + "+", " "))


def truncate(c: Column, n: int) -> Column:
    return F.substring(c, 1, n)


def tokens(c: Column) -> Column:
    """Different words of a text; a word is a run of letters, digits and underscores."""
    return F.array_distinct(F.filter(F.split(c, NOT_WORD, -1), lambda w: w != ""))


def pipe_list(c: Column) -> Column:
    """'a | B |' to [a, b]: split at bars, strip, fold, drop blanks."""
    return F.filter(F.transform(F.split(safe(c), r"\|", -1), lambda x: F.lower(py_strip(x))), lambda x: x != "")


def unique_list(c: Column) -> Column:
    return F.array_distinct(pipe_list(c))


def unique_spelling(c: Column) -> Column:
    """Items of a bar-separated list, unique when folded, in their first spelling."""
    items = F.filter(F.transform(F.split(safe(c), r"\|", -1), py_strip), lambda x: x != "")
    folded = F.transform(items, lambda x: F.lower(x))
    return F.filter(items, lambda x, i: F.array_position(folded, F.lower(x)) == i + 1)


def join_list(c: Column) -> Column:
    return F.array_join(c, " | ")


def exclusive_groups(user: Column, high: Column, every: Column, conversions: Column, n_conversions: int = 12) -> dict[str, Column]:
    """Keyword lists that do not repeat each other: user, high without user, all without both."""
    u, h, a = unique_list(user), unique_list(high), unique_list(every)
    return {"keywords_user": u, "keywords_highconf": F.array_except(h, u), "keywords_all": F.array_except(a, F.array_union(u, h)), "conv_keywords": F.slice(unique_list(conversions), 1, n_conversions)}


def assemble_text(fields: list[tuple[str, Column]], max_chars: int = 1800) -> Column:
    """'name: value' lines of the fields that are not blank, cut to max_chars code points."""
    lines = [F.when(py_strip(safe(c)) != "", F.concat(F.lit(f"{name}: "), py_strip(safe(c)))) for name, c in fields]
    return truncate(F.concat_ws("\n", *lines), max_chars)


def split_terms(terms) -> tuple[list[str], list[str]]:
    """Single words, which match whole tokens, and phrases, which match anywhere."""
    terms = sorted(set(terms))
    return [t for t in terms if not (" " in t or "-" in t)], [t for t in terms if " " in t or "-" in t]


def _literals(values) -> Column:
    return F.array(*map(F.lit, values)) if values else F.array().cast("array<string>")


def term_hits(text: Column, words: Column, terms) -> Column:
    """Which terms a normalised text holds, given its tokens; sorted."""
    single, phrases = split_terms(terms)
    hits = F.array_intersect(words, _literals(single))
    if phrases:
        hits = F.concat(hits, F.filter(_literals(phrases), lambda p: F.contains(text, p)))
    return F.array_sort(hits)


def substring_hits(text: Column, terms) -> Column:
    """Terms that occur anywhere, without regard to word ends; sorted."""
    low = F.lower(safe(text))
    return F.filter(_literals(sorted(set(terms))), lambda t: F.contains(low, t))


def clamp(c: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def round_half_even(c: Column, digits: int = 3) -> Column:
    """Rounds the binary value to the nearest, ties to even, as Python does.

    The value is split in two halves whose products with 10 ** digits are exact,
    so that what looks like a tie in decimal is seen on its true side.
    """
    scale, x = F.lit(float(10**digits)), F.abs(c)
    wide = x * F.lit(134217729.0)
    high = wide - (wide - x)
    k = F.floor(x * scale).cast("double")
    over = (high * scale - k - F.lit(0.5)) + (x - high) * scale
    up = F.when(over > 0, 1.0).when((over == 0) & (k % 2 == 1), 1.0).otherwise(0.0)
    return F.signum(c) * (k + up) / scale


def number(c: Column) -> Column:
    """Text to double; what is no number, and NaN, is null."""
    return F.nanvl(c.try_cast("double"), F.lit(None).cast("double"))


def ext_from_url(url: Column, mime: Column | None = None) -> Column:
    """File extension by content type, else by one of four URL suffixes, else .jpg."""
    path = F.substring_index(F.lower(safe(url)), "?", 1)
    by_url = F.coalesce(F.nullif(F.regexp_extract(path, r"(\.(?:jpg|jpeg|png|webp))$", 1), F.lit("")), F.lit(".jpg"))
    if mime is None:
        return by_url
    kind = F.lower(F.trim(F.substring_index(safe(mime), ";", 1)))
    known = {"image/jpeg": ".jpg", "image/pjpeg": ".jpg", "image/png": ".png", "image/webp": ".webp", "image/gif": ".gif", "image/bmp": ".bmp", "image/tiff": ".tiff", "image/avif": ".avif", "image/heic": ".heic", "image/svg+xml": ".svg", "text/html": ".html"}
    return F.coalesce(F.element_at(F.create_map(*(F.lit(x) for kv in known.items() for x in kv)), kind), by_url)


def shard_path(item_id: Column, ext: Column, root: str = "raw") -> Column:
    """root/ab/cd/abcdef.ext; xx for a missing pair."""
    part = lambda a: F.lower(F.coalesce(F.nullif(F.substring(safe(item_id), a, 2), F.lit("")), F.lit("xx")))
    return F.concat_ws("/", F.lit(root), part(1), part(3), F.concat(safe(item_id), ext))


def safe_name(c: Column, style: str = "runs", fallback: str = "unknown") -> Column:
    """Names fit for files: 'runs' replaces runs of forbidden characters and collapses white space, 'each' every
    forbidden character, 'slashes' only slashes."""
    if style == "slashes":
        return F.translate(safe(c), "/\\", "__")
    if style == "each":
        name = F.trim(F.regexp_replace(py_strip(safe(c)), r'[\\/:*?"<>|]', "_"))
    else:
        name = py_strip(F.regexp_replace(F.regexp_replace(py_strip(safe(c)), r'[\\/:*?"<>|]+', "_"), f"{PY_SPACE}+", " "))
    return F.when(name == "", fallback).otherwise(name)


def human_size(n: Column) -> Column:
    """Bytes as 12.34 MB."""
    out = F.concat(F.format_number(n / 1024**4, 2), F.lit(" TB"))
    for power, unit in ((3, "GB"), (2, "MB"), (1, "KB"), (0, "B")):
        value = F.format_number(n / 1024**power, 2)
        out = F.when(n < 1024 ** (power + 1), F.concat(value, F.lit(f" {unit}"))).otherwise(out)
    return F.regexp_replace(out, ",", "")


def parsed_or_raw(c: Column, schema: str) -> Column:
    """A struct (value, raw): value parsed as JSON; raw the text where it cannot be."""
    value = F.from_json(c, f"{schema}, _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    broken = value.isNull() | value["_corrupt"].isNotNull()
    return F.struct(F.when(~broken, value).alias("value"), F.when(broken, c).alias("raw"))


def iso_now() -> Column:
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")
