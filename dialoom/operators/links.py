"""Lookups by a chain of keys: the first link that has a match gives the value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def _named(name: str, key: Column) -> Column:
    """The keys of one link with its name; a name that ends in ``[]`` has an array of keys."""
    link = F.lit(name.removesuffix("[]")).alias("link")
    keys = F.coalesce(key, F.array().cast("array<string>")) if name.endswith("[]") else F.array(key)
    return F.transform(keys, lambda v: F.struct(link, v.cast("string").alias("key")))


def first_link(items: DataFrame, by: str, keys: list[tuple[str, Column]], found: DataFrame, has: list[tuple[str, Column]], value: str) -> DataFrame:
    """For each ``by`` the value under the first of its keys that ``found`` has, and ``via``, that link's name.

    ``keys`` are names of links with the key to look for, in order of precedence; ``has`` are names with the keys a row of
    ``found`` goes by, ``name[]`` with an array where it goes by several.  Of several values under one key the least counts.  Null keys match
    nothing; items without a match have nulls.  However long the chain is, this is one join on (link, key), for which
    ``found`` has been reduced to one row a key, so a key that many rows share costs no more than another.
    """
    asked = F.array(*[F.struct(F.lit(i).alias("rank"), F.lit(n).alias("link"), k.cast("string").alias("key")) for i, (n, k) in enumerate(keys)])
    known = F.flatten(F.array(*[_named(n, k) for n, k in has]))
    q = items.select(F.col(by), F.explode(asked).alias("a")).select(by, "a.rank", "a.link", "a.key")
    f = found.select(F.col(value).alias("__value"), F.explode(known).alias("k")).select("k.link", "k.key", "__value").filter("key IS NOT NULL").groupBy("link", "key").agg(F.min("__value").alias("__value"))
    best = F.min(F.when(F.col("__value").isNotNull(), F.struct("rank", "__value", "link")))
    return q.join(f, ["link", "key"], "left").groupBy(by).agg(best.alias("b")).select(by, F.col("b.__value").alias(value), F.col("b.link").alias("via"))


def source_audio(parts: DataFrame, audio: DataFrame) -> DataFrame:
    """The recording of each part: by year and source file, by the file's name, by year and folder, by the folder's name, then by date,
    of the part's year first.

    ``parts``: part_id, year, folder, source_file, day; ``audio``: path of ``.../year/name.ext`` and day.
    """
    source = F.regexp_replace("source_file", r"(?i)\.json$", "")
    folder = base_name(F.regexp_replace("folder", r"(?i)_processed$", ""))
    under = lambda a, b: F.concat(a, F.lit("/"), b)
    present = lambda c, k: F.when(c.isNotNull() & (c != ""), k)
    keys = [
        ("year and file", present(source, under(F.col("year"), source))), ("file", present(source, base_name(source))), ("year and folder", present(folder, under(F.col("year"), folder))),
        ("folder", present(folder, folder)), ("day and year", F.concat("day", F.lit("|"), "year")), ("day", F.col("day")),
    ]
    stem = F.regexp_replace(base_name(F.col("path")), r"\.[^.]+$", "")
    years = F.slice(F.split("path", "/"), 1, F.greatest(F.size(F.split("path", "/")) - 1, F.lit(0)))
    relative = under(F.try_element_at(years, F.lit(-1)), stem)
    has = [("year and file", relative), ("file", stem), ("year and folder", relative), ("folder", stem), ("day and year[]", F.transform(F.array_distinct(years), lambda y: F.concat(F.col("day"), F.lit("|"), y))), ("day", F.col("day"))]
    return first_link(parts, "part_id", keys, audio, has, "path")


def by_name_or_suffix(wanted: DataFrame, files: DataFrame, name: str = "name", path: str = "path") -> DataFrame:
    """The first path whose base name is the wanted one, else whose base name ends in it; names are 255 characters or less on any disk."""
    base = base_name(F.col(path))
    ends = F.transform(F.sequence(F.lit(1), F.greatest(F.length(base), F.lit(1))), lambda k: F.right(base, k))
    asked = F.when(F.col(name) != "", F.col(name))
    return first_link(wanted, name, [("name", asked), ("suffix", asked)], files, [("name", base), ("suffix[]", ends)], path)


def one_by_key(df: DataFrame, key: str, value: object, *order: Column) -> DataFrame:
    """One record by a unique key, or the first of several in the given order."""
    rows = df.filter(F.col(key) == F.lit(value))
    return (rows.orderBy(*order) if order else rows).limit(1)


def with_positions(items: DataFrame, progress: DataFrame, key: str) -> DataFrame:
    """Adds ``position`` of a playback map (``map<string,double>`` in column ``positions``): 0 where it has none or no finite number."""
    known = progress.select(F.explode("positions").alias(key, "position")).filter(F.col("position").isNotNull() & ~F.isnan("position") & (F.abs("position") != float("inf")))
    known = known.groupBy(key).agg(F.max("position").alias("position"))
    return items.join(known, key, "left").withColumn("position", F.coalesce("position", F.lit(0.0)))


def greedy_names(local: DataFrame, known: DataFrame, key: str, window: tuple[float, float], who: str = "speaker") -> DataFrame:
    """Local speakers matched one-to-one to known ones by falling overlap inside ``window``; the others get new names.

    A pair's score is the longest overlap of a row of the one with a row of the
    other; equal scores go by falling names.  New names are SPEAKER_nn from the
    number of known speakers of the key on, in order of the local names.  Scores
    are combined to one row a pair before they meet, so a key's fold runs over
    speakers, not over rows.
    """
    from dialoom.operators.intervals import overlap_join

    lo, hi = window
    inside = (F.least("end_s", F.lit(hi)) > F.greatest("start_s", F.lit(lo)))
    a = local.filter(inside).select(key, F.col(who).alias("local"), F.col("start_s").alias("ls"), F.col("end_s").alias("le"))
    b = known.filter(inside).select(key, F.col(who).alias("known"), F.col("start_s").alias("rs"), F.col("end_s").alias("re"))
    both = overlap_join(a, b, key, ("ls", "le"), ("rs", "re")).withColumn("o", F.least("le", "re") - F.greatest("ls", "rs")).filter("o > 0")
    scores = both.groupBy(key, "local", "known").agg(F.max("o").alias("o")).groupBy(key).agg(F.reverse(F.array_sort(F.collect_list(F.struct("o", "local", "known")))).alias("pairs"))
    taken = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    free = lambda m, x: ~F.map_contains_key(m, x.local) & ~F.array_contains(F.map_values(m), x.known)
    fold = F.aggregate("pairs", taken, lambda m, x: F.when(free(m, x), F.map_concat(m, F.create_map(x.local, x.known))).otherwise(m))
    names = local.groupBy(key).agg(F.array_sort(F.collect_set(who)).alias("names"))
    count = known.groupBy(key).agg(F.count_distinct(who).alias("n_known"))
    matched = names.join(scores.select(key, fold.alias("found")), key, "left").join(count, key, "left").select(key, "names", F.coalesce("found", taken).alias("found"), F.coalesce("n_known", F.lit(0)).alias("n_known"))
    fresh = matched.withColumn("fresh", F.filter("names", lambda x: ~F.map_contains_key("found", x)))
    new = F.concat(F.lit("SPEAKER_"), F.lpad((F.col("n_known") + F.array_position("fresh", F.col("local")) - 1).cast("string"), 2, "0"))
    return fresh.select(key, "found", "n_known", "fresh", F.explode("names").alias("local")).select(key, "local", F.coalesce(F.try_element_at("found", F.col("local")), new).alias("global"), F.map_contains_key("found", F.col("local")).alias("matched"))
