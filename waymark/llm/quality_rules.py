r"""Quality rules with adaptive thresholds from mergeable quantile sketches.

Built-in SQL functions only. One pass takes the features of each text; KLL
sketches of each feature, and of its values above zero, are aggregated for each
language and source, and the same sketches merge into those of the language and
of everything. Thresholds come from the sketches themselves: a fence lies beyond
an outer quantile by a multiple of its distance from the median, so a group of
longer words or more repeats has wider fences. A feature that is zero in nine of
ten documents has no such distance; its fence is a multiple of the lower quartile
of the values above zero, so it follows their size. A group's fence is blended
with its language's, and that with the one of everything, by their numbers of
documents: the more a group has, the more its own decides, without a step.
Fences meet the features by a join of a row for each group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

MIN_WORDS = 50
#: Documents at which a group's own fence weighs as much as the one it is blended with.
BLEND = 100
#: Accuracy of the sketches: rank error of about 0.7 %.
SKETCH_K = 400
#: Outer quantile of the upper fence; the lower one mirrors it.
OUTER = 0.9
#: Feature: how many times the distance of outer quantile and median the fence lies beyond that quantile.
FENCE = {"symbol_share": 4.0, "dup_line_share": 4.0, "repeat_share": 10.0, "mean_word": 4.0}
#: Without such a distance: how many times the lower quartile of the values above zero the fence is.
RARE = {"symbol_share": 0.5, "dup_line_share": 4.0, "repeat_share": 4.0, "mean_word": 1.5}
#: The lower fence, for features that can also be too small.
LOW = ("mean_word",)

_SPACE = r"[\\x20\\x09-\\x0D]+"
_BITS = 28


def text_features(docs: DataFrame) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_lines, n_dup_lines and n_repeat_words of `text`; null counts as no words.

    Repeated windows are found by sorting 36 hash bits packed with the window's
    place, in the row; windows that share their bits are then compared as text.
    """
    step = docs.withColumn("_w", F.expr(rf"filter(split(coalesce(text, ''), '{_SPACE}'), x -> x <> '')"))
    step = step.withColumn("n_words", F.size("_w").cast("long")).withColumn("word_chars", F.expr("cast(length(array_join(_w, '')) as bigint)"))
    step = step.withColumn("n_symbols", F.expr(r"cast(coalesce(regexp_count(text, '[#*$%&|<>]'), 0) as bigint)"))
    step = step.withColumn("_l", F.expr(r"filter(split(coalesce(text, ''), '\\n'), x -> x rlike '[^\\x20\\x09-\\x0D]')"))
    step = step.withColumn("n_lines", F.size("_l").cast("long")).withColumn("n_dup_lines", F.expr("cast(size(_l) - size(array_distinct(_l)) as bigint)")).drop("_l")
    step = step.withColumn("_p", F.expr(f"case when n_words >= 4 then sort_array(transform(sequence(0, cast(n_words as int) - 3), i -> shiftleft(xxhash64(_w[i], _w[i + 1], _w[i + 2]), {_BITS}) | cast(i as bigint))) end"))
    same = f"shiftright(x, {_BITS}) = shiftright(coalesce(get(_p, j {{}} 1), ~x), {_BITS})"
    step = step.withColumn("_c", F.expr(f"transform(filter(_p, (x, j) -> {same.format('-')} or {same.format('+')}), x -> cast(x & {(1 << _BITS) - 1} as int))")).drop("_p")
    step = step.withColumn("_s", F.expr("case when size(_c) > 0 then sort_array(transform(_c, i -> struct(concat_ws(' ', _w[i], _w[i + 1], _w[i + 2]) as k, i as i))) end")).drop("_c", "_w")
    step = step.withColumn("_d", F.expr("filter(_s, (x, j) -> x.k = get(_s, j - 1).k or x.k = get(_s, j + 1).k)")).drop("_s")
    return step.withColumn("n_repeat_words", F.expr("cast(coalesce(size(array_distinct(flatten(transform(_d, x -> array(x.i, x.i + 1, x.i + 2))))), 0) as bigint)").cast("long")).drop("_d")


def _share(top: str, bottom: str) -> Column:
    return F.when(F.col(bottom) > 0, F.col(top) / F.col(bottom)).otherwise(F.lit(0.0))


def thresholds(rows: DataFrame) -> DataFrame:
    """Fences for each lang and source of rows that hold the features: a struct `fence` of <feature>.high and .low (null: none)."""
    above = {f: F.when(F.col(f) > 0, F.col(f)) for f in FENCE}
    level = rows.groupBy("lang", "source").agg(
        F.count("*").alias("n"), *(F.kll_sketch_agg_double(f, SKETCH_K).alias(f) for f in FENCE),
        *(F.kll_sketch_agg_double(x, SKETCH_K).alias(f"{f}_above") for f, x in above.items()), *(F.count(x).alias(f"{f}_n") for f, x in above.items()))

    def merged(*by: str) -> DataFrame:
        return level.groupBy(*by).agg(F.sum("n").alias("n"), *(F.kll_merge_agg_double(c, SKETCH_K).alias(c) for f in FENCE for c in (f, f"{f}_above")), *(F.sum(f"{f}_n").alias(f"{f}_n") for f in FENCE))

    def fences(sketches: DataFrame, name: str) -> DataFrame:
        """weight: documents that the fence rests on."""
        out = []
        for f, times in FENCE.items():
            low, mid, high = (F.kll_sketch_get_quantile_double(f, F.lit(q)) for q in (1 - OUTER, 0.5, OUTER))
            quartile = F.when(F.col(f"{f}_n") > 0, F.kll_sketch_get_quantile_double(f"{f}_above", F.lit(0.25)))
            up, down = high - mid, mid - low
            out.append(F.struct(
                F.when(up > 0, high + times * up).otherwise(RARE[f] * quartile).alias("high"),
                F.when(down > 0, low - times * down).otherwise(low / RARE[f]).alias("low"),
                F.when(up > 0, F.col("n")).otherwise(F.col(f"{f}_n")).alias("weight")).alias(f))
        keys = [c for c in ("lang", "source") if c in sketches.columns]
        return sketches.select(*keys, F.struct(*out).alias(name))

    def blend(own: str, wider, f: str, side: str) -> Column:
        x, w = F.col(f"{own}.{f}.{side}"), F.col(f"{own}.{f}.weight")
        return F.coalesce((w * x + BLEND * wider) / (w + BLEND), wider, x)

    own, lang, every = fences(level, "own"), fences(merged("lang"), "of_lang").withColumnRenamed("lang", "_lang"), fences(merged(), "of_all")
    both = own.join(lang, F.col("lang").eqNullSafe(F.col("_lang")), "left").drop("_lang").crossJoin(F.broadcast(every))  # one row
    final = [F.struct(*(blend("own", blend("of_lang", F.col(f"of_all.{f}.{side}"), f, side), f, side).alias(side) for side in ("high", "low"))).alias(f) for f in FENCE]
    return both.select("lang", "source", F.struct(*final).alias("fence"))


def _judged(rows: DataFrame) -> DataFrame:
    """rows (lang, source, text and any others but the new ones): features, base_failed and kept for every row; text goes."""
    rows = text_features(rows).drop("text")
    rows = rows.withColumns({
        "symbol_share": _share("n_symbols", "word_chars"),
        "dup_line_share": _share("n_dup_lines", "n_lines"),
        "repeat_share": _share("n_repeat_words", "n_words"),
        "mean_word": _share("word_chars", "n_words"),
        "base_failed": (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
    })
    rows = materialize(rows)
    cut = thresholds(rows.where("not base_failed")).withColumnsRenamed({"lang": "_lang", "source": "_source"})
    joined = rows.join(cut, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left").drop("_lang", "_source")
    bad = F.lit(False)
    for f in FENCE:
        bad = bad | (F.col(f) > F.col(f"fence.{f}.high"))
        if f in LOW:
            bad = bad | (F.col(f) < F.col(f"fence.{f}.low"))
    return joined.withColumn("kept", ~F.col("base_failed") & ~F.coalesce(bad, F.lit(False))).drop("fence")


def quality_rules(docs: DataFrame) -> DataFrame:
    """Features, base_failed and kept for every row of documents.

    Thresholds are those of the documents of the row's lang and source that pass
    the base rule, blended with those of the lang and of everything.
    Null and empty texts have no words and fail the base rule; texts of any
    length are used whole. Null lang or source is a group of its own. Rows that
    repeat each get their row; an empty table gives none; other columns are ignored.
    """
    return _judged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", "source"))


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of documents that pass, with all their columns, whatever their names.

    Each row is judged by itself, as in `quality_rules`, and travels with its verdict.
    """
    rows = docs.select("text", "lang", "source", F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    return _judged(rows).where("kept").select("row.*")
