"""URL rules by host suffix and path prefix, in DataFrame functions only.

Each URL is expanded into the expressions a rule could be written as. Those are
joined to the rules on a short prefix of their digest; the full digest confirms.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from smeltery.llm.common import free_name, lower_ascii, stored, whole_text

PREFIX_DIGITS = 8


def host_of(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return lower_ascii(F.regexp_extract(whole_text(url), r"(?s)\A.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """From behind the host to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(whole_text(url), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def expressions(host: Column, path: Column, labels: int, lengths: list[int]) -> Column:
    """Every host suffix of at most ``labels`` labels with every path prefix of one of the ``lengths``."""
    parts = F.split(host, r"\.")
    n = F.size(parts)
    starts = F.sequence(F.greatest(F.lit(1), n - F.lit(labels - 1)), n)
    suffixes = F.transform(starts, lambda i: F.array_join(F.slice(parts, i, n), "."))
    fitting = F.filter(F.array(*[F.lit(x) for x in lengths]), lambda x: x <= F.length(path))
    return F.flatten(F.transform(suffixes, lambda s: F.transform(
        fitting, lambda x: F.concat(s, F.substring(path, F.lit(1), x)))))


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` added.

    ``rules(host, path, verdict)``: a rule fits its host and all subdomains if
    the path of the URL starts with its path. The longest rule (host and path
    together) wins, of equal rules ``block``. Without a rule the verdict is
    ``default`` and ``rule`` is null. A null URL or one without ``://`` has an
    empty host and path and fits no rule. Rows of ``pages`` are all kept;
    columns of ``pages`` named like an added one are replaced. No rules at all
    give the default everywhere.

    Each distinct URL is judged once, so a URL that many pages share costs one
    expansion. ``rules`` may be large: only its number of labels per host and
    its distinct path lengths come to the driver.
    """
    known = rules.select(
        F.concat(lower_ascii(F.col("host")), F.col("path")).alias("rule"), (F.col("verdict") == "block").alias("blocks"),
        F.size(F.split("host", r"\.")).alias("labels"), F.length("path").alias("path_length"))
    shape = known.agg(F.max("labels"), F.sort_array(F.collect_set("path_length"))).first()
    plain = pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))}).drop("rule", "verdict")
    if shape[0] is None:
        return plain.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    digest = F.sha2(F.col("rule"), 256)
    hashed = known.select(F.substring(digest, 1, PREFIX_DIGITS).alias("short"), digest.alias("full"), "rule", "blocks")
    asked = pages.select(F.col(url).alias("asked")).where(F.col(url).isNotNull()).distinct()
    opened = (asked.select("asked", host_of(F.col("asked")).alias("host"), path_of(F.col("asked")).alias("path"))
              .where("host <> ''")
              .select("asked", F.explode(expressions(F.col("host"), F.col("path"), *shape)).alias("expression"))
              .select("asked", F.sha2("expression", 256).alias("digest"))
              .withColumn("short", F.substring("digest", 1, PREFIX_DIGITS)))
    hits = opened.join(hashed, "short").where("digest = full")
    best = hits.groupBy("asked").agg(F.max(F.struct(F.length("rule").alias("n"), "blocks", "rule")).alias("best"))
    of, told = free_name(plain, "asked"), free_name(plain, "blocks")
    judged = stored(best.select(F.col("asked").alias(of), F.col("best.rule").alias("rule"), F.col("best.blocks").alias(told)),
                    "judged-urls")
    verdict = F.when(F.col(told), "block").when(~F.col(told), "allow").otherwise(default)
    return plain.join(judged, F.col(url) == F.col(of), "left").withColumn("verdict", verdict).drop(of, told)
