"""Quality rules: robust multivariate outliers by minimum-covariance-determinant estimates.

Statistics of each text become a vector of transformed shares. Per language and source, concentration steps look for
the ``SUPPORT`` share of texts whose covariance has the smallest determinant: from a start at median and MAD,
each step takes mean and covariance of the texts that are nearest by the last estimate. A text is rejected
when its Mahalanobis distance from the final, reweighted estimate is beyond ``cut``.

All of it is DataFrame work. Moments are sums per group; the order statistics that the steps need (medians, the
distance that holds the support) are read from counts in narrow bins, which are bounded in number per group,
combine in the map tasks and don't depend on the layout. The matrices are small, so their inverses are written out
as column expressions (Cholesky).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctual.llm.common import NOT_SPACE, SPACE, text_or_empty
from punctual.staging import stage

# Fixed values of the base rules.
SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS = 20
REPEAT_PERCENT = 30
WINDOW = 8

FEATURES = ("word_length", "symbols", "capitals", "dup_lines", "repeats")
SUPPORT = 0.75
STEPS = 4
#: Squared distance beyond which a text is rejected: chi-square of 5 degrees, upper tail of about 1e-9.
CUT = 50.0
#: Chi-square of 5 degrees: median, and the 97.5 % point for the reweighting step.
CHI_MEDIAN, CHI_975 = 4.351, 12.833
#: Smallest variances: groups may hold texts that all agree in a statistic, and short texts vary more. Those of repeats are so wide
#: that repeats alone, below what the base rule allows, reject nothing.
FLOORS = (0.02, 0.0016, 0.0025, 0.01, 0.01)
#: Weights, in texts, of the language's centre in that of a group, and of wider scatter in the scatter of a group or language.
CENTRE_WEIGHT, SCATTER_WEIGHT = 5.0, 50.0
BINS = 64


def statistics(df: DataFrame, text: Column, *keep: Column) -> DataFrame:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and n_capitals of each text, beside ``keep``.

    Windows of words are compared by 64-bit hashes. Only texts with a window that occurs twice go on to positions.
    """
    names = [f"k{i}" for i in range(len(keep))]
    base = df.select(*[c.alias(n) for c, n in zip(keep, names)], text.alias("text"))
    # SQL strings have no \f: it would be the letter f.
    trimmed = F.expr(r"trim(BOTH ' \t\n\u000B\u000C\r' FROM text)")
    words = base.withColumns({
        "words": F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"{SPACE}+")),
        "lines": F.filter(F.split("text", "\n"), lambda x: x.rlike(NOT_SPACE)),
        "n_symbols": (F.length("text") - F.length(F.regexp_replace("text", SYMBOLS, ""))).cast("long"),
        "n_capitals": (F.length("text") - F.length(F.regexp_replace("text", r"\p{Lu}", ""))).cast("long"),
    }).drop("text")
    counted = words.withColumns({
        "n_words": F.size("words").cast("long"),
        "word_chars": F.length(F.array_join("words", "")).cast("long"),
        "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        "hashes": F.transform("words", lambda w: F.xxhash64(w)),
    }).drop("words", "lines")
    windows = counted.withColumn(
        "windows",
        F.when(F.col("n_words") < WINDOW, F.array().cast("array<bigint>")).otherwise(F.transform(
            F.sequence(F.lit(0), F.col("n_words").cast("int") - WINDOW),
            lambda i: F.xxhash64(*[F.get(F.col("hashes"), i + k) for k in range(WINDOW)]),
        )),
    ).drop("hashes")
    flagged = windows.withColumn(
        "windows", F.when(F.size(F.array_distinct("windows")) < F.size("windows"), F.col("windows")))
    located = flagged.withColumn(
        "sorted", F.when(F.col("windows").isNotNull(), F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    ).drop("windows")
    at = lambda i: F.get(F.col("sorted"), i)
    starts = located.withColumn("starts", F.when(F.col("sorted").isNotNull(), F.sort_array(F.transform(
        F.filter(
            F.sequence(F.lit(0), F.size("sorted") - 1),
            lambda i: F.coalesce(at(i)["h"] == at(i - 1)["h"], F.lit(False)) | F.coalesce(at(i)["h"] == at(i + 1)["h"], F.lit(False)),
        ), lambda i: at(i)["i"],
    )))).drop("sorted")
    covered = F.aggregate(
        F.col("starts"), F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda acc, p: F.struct((acc["n"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("n"), p.alias("last")),
        lambda acc: acc["n"].cast("long"),
    )
    return starts.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("starts")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def features() -> dict[str, Column]:
    """The transformed vector: log of the mean word length, and square roots of shares."""
    n, chars = F.greatest("n_words", F.lit(1)).cast("double"), F.greatest("word_chars", F.lit(1)).cast("double")
    root = lambda x: F.sqrt(F.least(x, F.lit(1.0)))
    return {
        "word_length": F.log(chars / n), "symbols": root(F.col("n_symbols") / chars), "capitals": root(F.col("n_capitals") / chars),
        "dup_lines": root(F.col("n_dup_lines") / n), "repeats": root(F.col("n_repeat_words") / n),
    }


def factor_sql(floors: Sequence[float]) -> list[str]:
    """Cholesky factor of cov_i_j plus the floors, entry by entry; later entries use earlier ones."""
    out = []
    for i in range(len(floors)):
        for j in range(i + 1):
            rest = f"coalesce(cov_{i}_{j}, 0D)" + (f" + {floors[i]}D" if i == j else "")
            rest += "".join(f" - low_{i}_{k} * low_{j}_{k}" for k in range(j))
            out.append(f"sqrt(greatest({rest}, 1e-12D)) as low_{i}_{j}" if i == j else f"({rest}) / low_{j}_{j} as low_{i}_{j}")
    return out


def distance_sql() -> list[str]:
    """Forward substitution from mean_i and low_i_j: z_i, and the squared Mahalanobis distance d2."""
    out = []
    for i, name in enumerate(FEATURES):
        rest = f"{name} - mean_{i}" + "".join(f" - low_{i}_{k} * z_{k}" for k in range(i))
        out.append(f"({rest}) / low_{i}_{i} as z_{i}")
    return [*out, " + ".join(f"z_{i} * z_{i}" for i in range(len(FEATURES))) + " as d2"]


def _bin_quantile(df: DataFrame, group: list[str], value: Column, share: float, name: str) -> DataFrame:
    """Per group, the upper edge of the bin in which the ``share`` of ``value`` is reached."""
    counted = df.select(*group, F.floor(value * BINS).cast("long").alias("bin")).groupBy(*group, "bin").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy(*group).orderBy("bin")
    whole = Window.partitionBy(*group)
    reached = counted.withColumns({"upto": F.sum("n").over(upto), "all": F.sum("n").over(whole)})
    return reached.filter(F.col("upto") >= F.lit(share) * F.col("all")).groupBy(*group).agg(((F.min("bin") + 1) / BINS).alias(name))


def log2_of(d2: Column) -> Column:
    return F.log2(F.greatest(d2, F.lit(2.0 ** -20)))


def _with(rows: DataFrame, small: DataFrame, group: list[str]) -> DataFrame:
    columns = [c for c in small.columns if c not in group]
    right = small.select(*[F.col(c).alias(f"_{c}") for c in group], *columns)
    return rows.join(right, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in group]).select(*rows.columns, *columns)


def _moments(rows: DataFrame, group: list[str], floors: Sequence[float], inside: Column, label: str) -> DataFrame:
    """Mean and inverse factor of the rows inside, per group, written."""
    p = len(FEATURES)
    x = [F.when(inside, F.col(f)) for f in FEATURES]
    sums = rows.groupBy(*group).agg(
        *[F.avg(x[i]).alias(f"mean_{i}") for i in range(p)],
        *[F.covar_pop(x[i], x[j]).alias(f"cov_{i}_{j}") for i in range(p) for j in range(i + 1)],
    )
    means = [f"coalesce(mean_{i}, 0D) as mean_{i}" for i in range(p)]
    return stage(sums.selectExpr(*group, *means, *factor_sql(floors)), label)


def estimates(vectors: DataFrame, group: list[str], support: float = SUPPORT, steps: int = STEPS, floors: Sequence[float] = FLOORS) -> DataFrame:
    """Per group: mean_i and low_i_j of the reweighted minimum-covariance-determinant estimate.

    ``vectors`` (written) has the group's columns and FEATURES. The estimate is a fixed number of steps, so reruns
    and other layouts give the same rejections but for rounding.
    """
    p = len(FEATURES)
    # Medians and MADs of all statistics in one pass each: one row per statistic, finer bins.
    long = vectors.select(*group, F.posexplode(F.array(*FEATURES)).alias("f", "x"))
    medians = stage(_bin_quantile(long, [*group, "f"], F.col("x") * 16, 0.5, "m16").withColumn("median", F.col("m16") / 16).drop("m16"), "mcd-medians")
    spread = _with(long, medians, [*group, "f"])
    mads = _bin_quantile(spread, [*group, "f"], F.abs(F.col("x") - F.col("median")) * 16, 0.5, "mad16")
    both = _with(medians, mads, [*group, "f"])
    one = lambda i, c: F.max(F.when(F.col("f") == i, c))
    params = both.groupBy(*group).agg(
        *[one(i, F.col("median")).alias(f"mean_{i}") for i in range(p)],
        *[(one(i, F.sqrt(F.pow(F.col("mad16") / 16 * 1.4826, 2) + floors[i])) if i == j else F.max(F.lit(0.0))).alias(f"low_{i}_{j}")
          for i in range(p) for j in range(i + 1)],
    )
    params = stage(params, "mcd-start")
    for step in range(steps):
        near = _with(vectors, params, group).selectExpr("*", *distance_sql())
        edge = stage(_bin_quantile(near, group, log2_of(F.col("d2")), support, "edge"), "mcd-edge")
        params = _moments(_with(near, edge, group), group, floors, log2_of(F.col("d2")) <= F.col("edge"), f"mcd-step-{step}")
    # Scatter of the central part is too small; its median distance shows by how much.
    near = _with(vectors, params, group).selectExpr("*", *distance_sql())
    middle = stage(_bin_quantile(near, group, log2_of(F.col("d2")), 0.5, "middle"), "mcd-middle")
    weight = F.greatest(F.pow(F.lit(2.0), F.col("middle")) / CHI_MEDIAN, F.lit(1.0))
    return _moments(_with(near, middle, group), group, floors, F.col("d2") <= CHI_975 * weight, "mcd-reweighted")


def _scatter_sql(i: int, j: int) -> str:
    """Entry of the covariance (floors included) of a factor."""
    return " + ".join(f"low_{i}_{k} * low_{j}_{k}" for k in range(j + 1))


def judges(vectors: DataFrame) -> DataFrame:
    """Per language and source of ``vectors`` (written): g_lang, g_source, mean_i and low_i_j.

    Each group has an estimate of its own, whatever its size. Its centre is weighed with that of its language, its scatter with
    the language's, and the language's with the scatter inside all languages, in proportion to the number of texts, so that no
    size makes a jump. Nothing is centred on other languages.
    """
    p = range(len(FEATURES))
    entries = [(i, j) for i in p for j in range(i + 1)]
    level = lambda n, source: vectors.select("g_lang", source.alias("g_source"), F.lit(n).alias("level"), *FEATURES)
    group = ["g_lang", "g_source", "level"]
    both = level(0, F.col("g_source")).unionByName(level(1, F.lit(None).cast("string")))
    sizes = stage(both.groupBy(*group).agg(F.count(F.lit(1)).cast("double").alias("n")), "mcd-sizes")
    found = _with(sizes, estimates(both, group), group).selectExpr(
        *group, "n", *[f"mean_{i}" for i in p], *[f"{_scatter_sql(i, j)} as s_{i}_{j}" for i, j in entries])
    found = stage(found, "mcd-found")
    inside = found.filter("level = 1").agg(*[(F.sum(F.col("n") * F.col(f"s_{i}_{j}")) / F.sum("n")).alias(f"s_{i}_{j}") for i, j in entries]).first()
    blend = lambda own, wide, weight: f"(n * {own} + {weight}D * ({wide})) / (n + {weight}D)"
    languages = found.filter("level = 1").withColumns({f"w_{i}_{j}": F.lit(inside[f"s_{i}_{j}"]).cast("double") for i, j in entries}).selectExpr(
        "g_lang", *[f"mean_{i} as lang_mean_{i}" for i in p],
        *[f"{blend(f's_{i}_{j}', f'w_{i}_{j}', SCATTER_WEIGHT)} as lang_s_{i}_{j}" for i, j in entries])
    mixed = _with(found.filter("level = 0"), languages, ["g_lang"]).selectExpr(
        "g_lang", "g_source", *[f"{blend(f'mean_{i}', f'lang_mean_{i}', CENTRE_WEIGHT)} as mean_{i}" for i in p],
        *[f"{blend(f's_{i}_{j}', f'lang_s_{i}_{j}', SCATTER_WEIGHT)} as cov_{i}_{j}" for i, j in entries])
    return stage(mixed.selectExpr("g_lang", "g_source", *[f"mean_{i}" for i in p], *factor_sql([0.0] * len(FEATURES))), "mcd-judges")


def judged(counts: DataFrame, lang: str, source: str, cut: float = CUT) -> DataFrame:
    """``counts`` (written, from ``statistics``) with base_failed, distance and kept.

    Estimates (``judges``) are fitted to texts which pass the base rules. Null languages or sources make groups of their own.
    In a group without such a text the base rule rejects all, and the distance is null.
    """
    vectors = stage(
        counts.filter(~base_failed()).select(F.col(lang).alias("g_lang"), F.col(source).alias("g_source"), *[c.alias(n) for n, c in features().items()]),
        "mcd-vectors",
    )
    rows = counts.withColumns({"base_failed": base_failed(), **features()})
    chosen = rows.join(judges(vectors), F.col(lang).eqNullSafe(F.col("g_lang")) & F.col(source).eqNullSafe(F.col("g_source")), "left")
    measured = chosen.selectExpr("*", *distance_sql()).withColumn("distance", F.col("d2"))
    return measured.withColumn("kept", ~F.col("base_failed") & (F.coalesce("d2", F.lit(0.0)) <= cut)).select(
        *counts.columns, "base_failed", "distance", "kept")


def rules(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang", source_column: str = "source") -> DataFrame:
    """Per row: doc_id, the statistics, base_failed, distance and kept. Null texts count as empty and fail the base rule."""
    counts = stage(
        statistics(df, text_or_empty(text_column), F.col(f"`{id_column}`"), F.col(f"`{lang_column}`"), F.col(f"`{source_column}`"))
        .withColumnsRenamed({"k0": "doc_id", "k1": "lang", "k2": "source"}),
        "rule-statistics",
    )
    return judged(counts, "lang", "source").drop("lang", "source")


def kept_documents(df: DataFrame, text_column: str = "text", lang_column: str = "lang", source_column: str = "source") -> DataFrame:
    """The rows that the rules keep, with the columns that came in."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    counts = stage(
        statistics(df, text_or_empty(text_column), row, F.col(f"`{lang_column}`"), F.col(f"`{source_column}`"))
        .withColumnsRenamed({"k0": "row", "k1": "g_lang_of", "k2": "g_source_of"}),
        "rule-statistics",
    )
    return judged(counts, "g_lang_of", "g_source_of").filter("kept").select("row.*")
