"""Benchmark decontamination by template windows, in DataFrame functions only.

Numbers, names and units become typed placeholders, so a question asked again
with other parameters has the same template. Windows of template tokens, and windows
of the plain tokens in lower case, are hash-joined with those of the benchmark;
windows that are equal word for word always count, the others of an aligned run
only if every parameter was replaced consistently. Items shorter than a window
are looked for as runs of their own length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from smeltery.llm.common import free_name, stored, whole_text

WINDOW = 8
#: A window has to keep this many tokens that are no placeholders.
LITERALS = 4
#: Share of an item's windows from which a document counts as contaminated by it.
COVERAGE = 0.3
#: Windows of the benchmark are broadcast up to this many (some 50 MB); beyond it the join is shuffled.
BROADCAST_WINDOWS = 250_000
#: Units that follow a number.
UNITS = ("kg", "g", "mg", "lb", "lbs", "oz", "km", "m", "cm", "mm", "mi", "ft", "in", "l", "ml", "h", "hr", "hrs", "hour",
         "hours", "min", "minute", "minutes", "s", "sec", "second", "seconds", "day", "days", "week", "weeks", "month",
         "months", "year", "years", "dollar", "dollars", "euro", "euros", "cent", "cents", "percent", "%", "$", "€", "£", "°")


def tokens_text(text: Column) -> Column:
    """Tokens with one space between: words, numbers with inner points and commas, currency and unit signs."""
    spaced = F.regexp_replace(text, r"(?:[^\p{L}\p{M}\p{Nd}%$€£°.,]|[.,](?![0-9])|(?<![0-9])[.,])+", " ")
    apart = F.regexp_replace(spaced, r"(?<=[0-9])(?=[\p{L}%$€£°])|(?<=[%$€£°\p{L}])(?=[0-9$€£%°])", " ")
    return F.trim(F.when(text.rlike("[0-9$€£%°]"), apart).otherwise(spaced))


def template_text(tokens: Column) -> Column:
    """The same number of tokens with typed placeholders, the rest in lower case."""
    numbers = F.regexp_replace(tokens, r"(?<![^ ])[0-9][0-9.,]*(?![^ ])", "<num>")
    units = F.regexp_replace(numbers, rf"(?<=<num> )(?i:{'|'.join(u.replace('$', chr(92) + '$') for u in UNITS)})(?![^ ])", "<unit>")
    measured = F.when(tokens.rlike("[0-9]"), units).otherwise(tokens)
    return F.lower(F.regexp_replace(measured, r"(?<![^ ])\p{Lu}[\p{Ll}\p{M}]+(?![^ ])", "<name>"))


def windows_of(template: Column, width: int = WINDOW) -> Column:
    """Every window of ``width`` tokens in order; a shorter text is one window."""
    whole = rf"(?<!.)(?:[^ ]+ ){{0,{width - 2}}}[^ ]+(?!.)"
    return F.regexp_extract_all(template, F.lit(rf"(?<![^ ])(?=((?:[^ ]+ ){{{width - 1}}}[^ ]+|{whole}))"), F.lit(1))


def runs_of(tokens: Column, length: int) -> Column:
    """Every run of exactly ``length`` tokens in order."""
    return F.regexp_extract_all(tokens, F.lit(rf"(?<![^ ])(?=((?:[^ ]+ ){{{length - 1}}}[^ ]+)(?![^ ]))"), F.lit(1))


def _opened(df: DataFrame, key: str, text: str, name: str, width: int, lengths: tuple[int, ...] = ()) -> DataFrame:
    """``(name, tokens, at, window)``: the plain windows, and the template windows where they differ. Tokens are in lower case.

    Plain runs of each of ``lengths`` come on top.
    """
    raw = df.select(F.col(key).alias(name), tokens_text(whole_text(text)).alias("raw"))
    texts = raw.select(name, F.lower("raw").alias("tokens"), template_text(F.col("raw")).alias("template"))
    both = F.arrays_zip(windows_of(F.col("tokens"), width).alias("plain"), windows_of(F.col("template"), width).alias("moved"))
    rows = texts.select(name, "tokens", F.posexplode(both).alias("at", "w"))
    kinds = F.when(F.col("w.plain") == F.col("w.moved"), F.array("w.plain")).otherwise(F.array("w.plain", "w.moved"))
    opened = rows.select(name, "tokens", "at", F.explode(kinds).alias("window"))
    for n in lengths:
        opened = opened.union(texts.select(name, "tokens", F.posexplode(runs_of(F.col("tokens"), n)).alias("at", "window")))
    return opened


def benchmark_windows(benchmark: DataFrame, key: str = "item_id", text: str = "text", width: int = WINDOW) -> DataFrame:
    """``(item, item_at, window, item_tokens, telling, item_windows, item_telling)``.

    Template windows of mostly placeholders are left out, as they fit too much;
    ``telling`` is false at their places, which only the plain windows cover.
    """
    opened = _opened(benchmark, key, text, "item", width)
    literal = F.size(F.filter(F.split("window", " "), lambda t: ~t.isin("<num>", "<name>", "<unit>")))
    rows = opened.select("item", F.col("at").alias("item_at"), "window", literal.alias("literal"),
                         F.slice(F.split("tokens", " "), F.col("at") + 1, width).alias("item_tokens"))
    need = F.least(F.lit(LITERALS), F.size("item_tokens"))
    told = rows.groupBy(F.col("item").alias("i"), F.col("item_at").alias("j")).agg(F.min(F.col("literal") >= need).alias("telling"))
    counts = told.groupBy(F.col("i").alias("of")).agg(F.count("*").alias("item_windows"), F.count_if("telling").alias("item_telling"))
    return (rows.where(F.col("literal") >= F.when(F.col("window").contains("<"), need).otherwise(0))
            .join(told, F.col("item").eqNullSafe(F.col("i")) & (F.col("item_at") == F.col("j")))
            .join(counts, F.col("item").eqNullSafe(F.col("of")))
            .select("item", "item_at", "window", "item_tokens", "telling", "item_windows", "item_telling"))


def contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
                 width: int = WINDOW, coverage: float = COVERAGE) -> DataFrame:
    """``(key, item_id, coverage, changed)``: each item found in a document.

    ``coverage`` is the share of the item's windows that are found, of all of
    them or of those whose template is not mostly placeholders, whichever is
    larger, at least the one asked for; ``changed`` tells whether a parameter
    differs; case does not count. A window with other parameters is found if
    those of its alignment are consistent: equal parameters of the item stay
    equal and different ones stay different. An item shorter than a window is
    found word for word anywhere, with other parameters only as a whole text;
    null and empty texts match nothing. Rows that share a key are one document.
    Other columns are not looked at.
    """
    items = stored(benchmark_windows(benchmark, width=width), "benchmark-windows")
    items = items.withColumn("mark", F.xxhash64("window")).withColumnRenamed("window", "item_window")
    if items.count() <= BROADCAST_WINDOWS:
        items = F.broadcast(items)
    size = F.size("item_tokens")
    lengths = tuple(sorted(r[0] for r in items.where(size < width).select(size).distinct().collect()))
    found = _opened(docs, key, text, "doc", width, lengths).withColumn("mark", F.xxhash64("window"))
    hits = found.join(items, "mark").where("window = item_window")
    slots = F.filter(F.arrays_zip(F.split("window", " ").alias("t"), F.col("item_tokens").alias("a"),
                                  F.slice(F.split("tokens", " "), F.col("at") + 1, width).alias("b")),
                     lambda z: z["t"].isin("<num>", "<name>", "<unit>"))
    place = F.struct(F.col("item_at").alias("at"), "telling")
    named = ["doc", "item", "item_windows", "item_telling"]
    compared = hits.select(*named, place.alias("place"), (F.col("at") - F.col("item_at")).alias("shift"),
                           F.transform(slots, lambda z: F.struct(z["a"].alias("a"), z["b"].alias("b"))).alias("slots"))
    other = F.exists("slots", lambda z: z["a"] != z["b"])
    aligned = (compared.withColumn("other", other).groupBy(*named, "shift")
               .agg(F.collect_set(F.when(~F.col("other"), F.col("place"))).alias("same"),
                    F.collect_set(F.when(F.col("other"), F.col("place"))).alias("moved"),
                    F.array_distinct(F.flatten(F.collect_set(F.when(F.col("other"), F.col("slots"))))).alias("slots")))
    side = lambda x: F.size(F.array_distinct(F.transform("slots", lambda z: z[x])))
    steady = (side("a") == F.size("slots")) & (side("b") == F.size("slots"))
    counted = aligned.select(*named, "same", F.when(steady, F.col("moved")).otherwise(F.slice("moved", 1, 0)).alias("moved"))
    shares = counted.groupBy(*named).agg(
        F.array_distinct(F.flatten(F.collect_list(F.concat("same", "moved")))).alias("places"),
        F.bool_or(F.size("moved") > 0).alias("changed"))
    share = F.greatest(F.size("places") / F.col("item_windows"),
                       F.size(F.filter("places", lambda p: p["telling"])) / F.nullif(F.col("item_telling"), F.lit(0)))
    return (shares.withColumn("coverage", share).where(F.col("coverage") >= coverage)
            .select(F.col("doc").alias(key), F.col("item").alias("item_id"), "coverage", "changed"))


def _identity(key: str, text: str = "text") -> Column:
    """The key as text; rows without one go by their text, so each is judged alone."""
    return F.coalesce(F.concat(F.lit("k"), F.col(key).cast("string")), F.concat(F.lit("t"), F.sha2(whole_text(text), 256)))


def judged(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """``(key, contaminated, n_items, items, coverage, changed)`` for every row of ``docs``; items comma-joined.

    Rows that share a key are one document; rows without a key are one each.
    """
    named = docs.select(key, _identity(key).alias("_doc"), "text")
    found = contaminated(named, benchmark, "_doc", **options)
    by_doc = stored(found.groupBy("_doc").agg(
        F.count("*").alias("n_items"), F.array_join(F.array_sort(F.collect_list("item_id")), ",").alias("items"),
        F.max("coverage").alias("coverage"), F.bool_or("changed").alias("changed")), "contaminated")
    return named.select(key, "_doc").join(by_doc, "_doc", "left").select(
        key, F.col("n_items").isNotNull().alias("contaminated"), F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.coalesce("items", F.lit("")).alias("items"), F.coalesce("coverage", F.lit(0.0)).alias("coverage"),
        F.coalesce("changed", F.lit(False)).alias("changed"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` in which no item was found; a row without a key goes for its own text only."""
    of = free_name(docs, "_doc")
    named = docs.select(_identity(key).alias(of), "text")
    found = stored(contaminated(named, benchmark, of).select(of).distinct(), "contaminated")
    return docs.join(found, _identity(key) == F.col(of), "left_anti")
