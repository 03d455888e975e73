"""Times, names, text and hashes as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Times


def hhmmss(seconds: Column) -> Column:
    """HHMMSS, fractions cut."""
    s = F.floor(seconds)
    return F.format_string("%02d%02d%02d", F.floor(s / 3600), F.floor(s / 60) % 60, s % 60)


def clock(seconds: Column) -> Column:
    """HH:MM:SS, from 0."""
    s = F.floor(F.greatest(seconds, F.lit(0)))
    return F.format_string("%02d:%02d:%02d", F.floor(s / 3600), F.floor(s / 60) % 60, s % 60)


def clock_hundredths(seconds: Column) -> Column:
    """HH:MM:SS.ss of the nearest hundredth, from 0."""
    h = F.floor(F.greatest(seconds, F.lit(0.0)) * 100 + 0.5)
    return F.format_string("%02d:%02d:%02d.%02d", F.floor(h / 360000), F.floor(h / 6000) % 60, F.floor(h / 100) % 60, h % 100)


def clock_wrapped(seconds: Column) -> Column:
    """HH:MM:SS.ss within a day, hundredths cut."""
    h = F.floor(seconds * 100) % 8640000
    return F.format_string("%02d:%02d:%02d.%02d", F.floor(h / 360000), F.floor(h / 6000) % 60, F.floor(h / 100) % 60, h % 100)


def srt_time(seconds: Column) -> Column:
    ms = F.floor(seconds * 1000)
    return F.format_string("%02d:%02d:%02d,%03d", F.floor(ms / 3600000), F.floor(ms / 60000) % 60, F.floor(ms / 1000) % 60, ms % 1000)


def parse_clock(text: Column) -> Column:
    """Seconds of HH:MM:SS(.f), MM:SS(.f) or a number; 0 for anything else."""
    parts = F.split(F.trim(text), ":")
    at = lambda k: F.get(parts, F.lit(k)).try_cast("double")
    value = (
        F.when(F.size(parts) == 3, at(0) * 3600 + at(1) * 60 + at(2)).when(F.size(parts) == 2, at(0) * 60 + at(1)).when(F.size(parts) == 1, at(0))
    )
    return F.coalesce(value, F.lit(0.0))


def chinese_date(text: Column) -> Column:
    """YYYY-MM-DD of a date written with year, month and day signs, else of eight digits or an ISO date."""
    cn = lambda k: F.regexp_extract(text, r"(\d{4})年(\d{1,2})月(\d{1,2})日", k)
    iso = lambda k: F.regexp_extract(text, r"(20\d{2})-?(\d{2})-?(\d{2})", k)
    join = lambda f: F.concat_ws("-", f(1), F.lpad(f(2), 2, "0"), F.lpad(f(3), 2, "0"))
    return F.when(cn(1) != "", join(cn)).when(iso(1) != "", join(iso))


# Names


def year_digits(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, r"20\d{2}", 0), F.lit(""))


def part_number(name: Column) -> Column:
    """The number after ``_part``, 0 without it."""
    return F.coalesce(F.regexp_extract(name, r"_part(\d+)", 1).try_cast("int"), F.lit(0))


def base_name(name: Column) -> Column:
    return F.regexp_replace(name, r"_part\d+", "")


def recording_name(name: Column) -> Column:
    """Date, start, end and tag of ``date_HHMMSS_HHMMSS_tag.mp3``."""
    pattern = r"^(.+)_(\d{6})_(\d{6})_(.+)\.mp3$"
    return F.struct(*[F.regexp_extract(name, pattern, k).alias(c) for k, c in enumerate(("date", "start", "end", "tag"), 1)])


def section_kind(name: Column) -> Column:
    low = F.lower(name)
    return F.when(low.contains("opening"), "opening").when(low.contains("call"), "call").when(low.contains("comment"), "comment").otherwise("unknown")


def safe_name(text: Column) -> Column:
    """Characters that file names cannot have become ``_``, and runs of it one."""
    return F.regexp_replace(F.regexp_replace(F.trim(text), r'[\\/:*?"<>|\s]+', "_"), "_+", "_")


def ascii_name(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"[^A-Za-z0-9._-]+", "_"), r"^_+|_+$", "")


# Text


def squeezed(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "))


def without_punctuation(text: Column) -> Column:
    return F.regexp_replace(text, r"[\s\p{Punct}，。！？、；：“”‘’（）《》…—]", "")


#: Interjections that alone say nothing.
FILLERS = "嗯啊哦呃额唉诶哎欸哈呵"


def is_filler(text: Column) -> Column:
    return F.trim(F.translate(text, FILLERS, "")) == ""


def has_control(text: Column) -> Column:
    return text.rlike(r"<\|[^|]*\|>|</?think>")


def without_control(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(text, r"(?s)<think>.*?</think>|</?think>", ""), r"<\|[^|]*\|>", ""))


def preview(text: Column, limit: int = 160) -> Column:
    t = F.trim(text)
    return F.when(F.length(t) > limit, F.concat(F.substring(t, 1, limit - 3), F.lit("..."))).otherwise(t)


def sentences(text: Column) -> Column:
    """Pieces that end with a sentence's last sign, which they keep."""
    return F.filter(F.transform(F.split(text, r"(?<=[。！？.!?])"), lambda s: F.trim(s)), lambda s: s != "")


def tokens(text: Column) -> Column:
    """Distinct Latin words of two characters or more, then distinct single ideographs."""
    low = F.lower(text)
    return F.array_distinct(F.concat(F.regexp_extract_all(low, F.lit(r"[a-z0-9]{2,}"), F.lit(0)), F.regexp_extract_all(low, F.lit("[一-鿿]"), F.lit(0))))


def memory_tokens(text: Column) -> Column:
    """Tokens of the first 400 characters, with runs of white space as one."""
    return tokens(F.substring(F.trim(F.regexp_replace(text, r"(?U)\s+", " ")), 1, 400))


def relevance(query: Column, item: Column, age_days: Column) -> Column:
    """Of two arrays of distinct tokens: 2 for each shared one, 3 more for each that is a number, and up to 1 that falls to 0 in fourteen days."""
    shared = F.array_intersect(item, query)
    numbers = F.filter(shared, lambda w: w.rlike("^[0-9]+$"))
    recency = F.greatest(F.lit(0.0), 1 - F.greatest(F.lit(0.0), age_days) / 14)
    return 2 * F.size(shared) + 3 * F.size(numbers) + recency


def first_match(text: Column, pairs: list[tuple[str, str]], default: str | None = None) -> Column:
    """The label of the first keyword, in the pairs' order, that the text holds."""
    out = F.lit(default)
    for keyword, label in reversed(pairs):
        out = F.when(text.contains(keyword), label).otherwise(out)
    return out


def estimated_tokens(lengths: Column) -> Column:
    """Of messages' lengths (role and content): a quarter of the characters with 8 a message, 1 at least."""
    return F.greatest(F.lit(1), F.ceil(F.aggregate(lengths, F.lit(0).cast("long"), lambda n, x: n + x + 8) / 4))


def occurrences(text: Column, phrases: list[str]) -> Column:
    """How often the phrases stand in a text, each counted for itself and without overlaps; a null text has none."""
    t = F.coalesce(text, F.lit(""))
    one = lambda p: ((F.length(t) - F.length(F.replace(t, F.lit(p), F.lit("")))) / len(p)).cast("long")
    return sum((one(p) for p in phrases[1:]), one(phrases[0]))


# Numbers


def clamped_score(text: Column) -> Column:
    """A whole number of 1 to 5, else null."""
    n = F.trim(text).try_cast("int")
    return F.when(n.between(1, 5), n)


def sigmoid_confidence(margin: Column) -> Column:
    return 1 / (1 + F.exp(-20 * (margin - 0.02)))


def overlap(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(e1, e2) - F.greatest(s1, s2))


def distance(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    """Between intervals; 0 where they overlap."""
    return F.greatest(F.lit(0.0), s2 - e1, s1 - e2)


# Hashes


def split_bucket(seed: str, key: Column) -> Column:
    """A stable number in [0, 1): twelve hex digits of SHA-1 of ``seed:key``."""
    return F.conv(F.substring(F.sha1(F.concat(F.lit(f"{seed}:"), key)), 1, 12), 16, 10).cast("long") / F.lit(float(2**48))


def stable_id(key: Column, prefix: str = "", size: int = 16) -> Column:
    return F.concat(F.lit(prefix), F.substring(F.sha1(key), 1, size))


def characters(text: Column) -> Column:
    """Each character, those beyond the basic plane whole."""
    n = F.length(text)
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda k: F.substr(text, k, F.lit(1)))).when(n == 0, F.array().cast("array<string>"))


def fnv32(text: Column) -> Column:
    """FNV-1a, 32 bits, over the first UTF-16 unit of each character: its code point, or beyond the basic plane the high surrogate."""
    point = lambda c: F.ascii(c).cast("long")
    unit = lambda c: F.when(point(c) > 0xFFFF, F.shiftright(point(c) - 0x10000, 10) + 0xD800).otherwise(point(c))
    step = lambda h, c: ((h.bitwiseXOR(unit(c))) * 16777619).bitwiseAND(F.lit(0xFFFFFFFF))
    return F.aggregate(characters(text), F.lit(2166136261), step)


def code_point_sum(text: Column) -> Column:
    return F.aggregate(F.filter(F.split(text, ""), lambda c: c != ""), F.lit(0), lambda n, c: n + F.ascii(c))
