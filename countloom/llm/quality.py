"""Quality rules as weak supervision, in DataFrame functions only.

Each rule votes good (+1) or bad (-1) or abstains (0). The votes of all documents are counted by
pattern (at most 3 ** rules rows), and expectation-maximisation on those counts estimates how often
each rule is right when it votes, together with the share of good documents. A document
is kept if its posterior probability of being good reaches the threshold. The whole fit is one
SQL fold over the iterations, on a single row that holds the pattern counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import let, small_or_not, written

#: The rules: name -> (condition for a bad vote, condition for a good vote), on the measures of features(). Most
#: rules look for one defect and abstain where it is missing: its absence says little of the others.
RULES = {
    "plain_words": ("n_plain < 0.60 * n_words", "n_plain >= 0.80 * n_words"),
    "lower_case": ("n_lower < 0.60 * word_chars", "n_lower >= 0.90 * word_chars"),
    "symbols": ("n_symbols > 0.10 * word_chars", "false"),
    "capitals": ("n_upper > 0.40 * word_chars", "false"),
    "repeats": ("n_repeat_words > 0.30 * n_words", "false"),
    "lines": ("n_dup_lines > 0.25 * n_lines", "false"),
    "shouts": ("n_shouts > 0.10 * n_words", "false"),
    "digits": ("n_digits > 0.30 * word_chars", "false"),
    "variety": ("n_types < 0.20 * n_words", "false"),
}
ITERATIONS = 30
#: Accuracy of a vote and share of good documents to start from; the weight of that accuracy in each
#: estimate, as a share of all documents; and the least and largest accuracy.
START_ACCURACY, START_SHARE, PRIOR, LEAST, LARGEST = 0.8, 0.8, 0.02, 0.55, 0.99

#: A word of letters, of any script, with sentence marks at its end; scripts without spaces have them inside too.
PLAIN = r"^[\p{L}\p{M}]+(?:[，、。；：！？][\p{L}\p{M}]+)*[.,;:，、。；：！？]?$"
#: Positions in 3-word windows found twice or more: windows are hashed, sorted with their positions,
#: and the union of the repeated windows is measured on their sorted positions.
_COVERED = let(
    "sort_array(transform(h, (x, i) -> struct(x as x, i as i)))",
    let(
        "sort_array(transform(filter(s, (e, k) -> get(s, k - 1).x = e.x or get(s, k + 1).x = e.x), e -> e.i))",
        "aggregate(transform(p, (v, k) -> coalesce(least(3, get(p, k + 1) - v), 3)), 0L, (a, b) -> a + b)",
        "p",
    ),
    "s",
)
_REPEATS = let(
    "if(size(w) >= 3, transform(sequence(0, size(w) - 3), i -> xxhash64(w[i], w[i + 1], w[i + 2])), cast(array() as array<bigint>))",
    f"if(size(array_distinct(h)) = size(h), 0L, {_COVERED})",
    "h",
)
_WORDS = let(
    r"regexp_extract_all(text, r'[^\x20\x09-\x0D]+', 0)",
    f"named_struct('n_words', cast(size(w) as bigint), 'n_types', cast(size(array_distinct(w)) as bigint), 'n_plain', cast(size(filter(w, x -> x rlike r'{PLAIN}')) as bigint), 'n_repeat_words', {_REPEATS})",
    "w",
)
_LINES = let(
    r"filter(split(text, '\n'), l -> l rlike r'[^\x20\x09-\x0D]')",
    "named_struct('n_lines', cast(size(l) as bigint), 'n_dup_lines', cast(size(l) - size(array_distinct(l)) as bigint))",
    "l",
)


def features(docs: DataFrame) -> DataFrame:
    """docs with the base measures of every whole text (null: empty)."""
    gone = lambda pattern: F.expr(f"cast(length(text) - length(regexp_replace(text, r'{pattern}', '')) as bigint)")
    d = docs.withColumn("text", F.coalesce("text", F.lit("")))
    return d.select(
        *[c for c in d.columns if c != "text"],
        "text",
        F.expr(_WORDS).alias("w"),
        F.expr(_LINES).alias("l"),
        F.expr(r"cast(length(regexp_replace(text, r'[\x20\x09-\x0D]+', '')) as bigint)").alias("word_chars"),
        gone("[#*$%&|<>]+").alias("n_symbols"),
        gone(r"\p{Lu}+").alias("n_upper"),
        gone(r"[\p{Ll}\p{Lo}\p{M}]+").alias("n_lower"),
        gone("[0-9]+").alias("n_digits"),
        gone("!+").alias("n_shouts"),
    ).select("*", "w.*", "l.*").drop("w", "l")


def with_votes(d: DataFrame) -> DataFrame:
    """Adds base_failed and votes, an array with one vote for each rule."""
    votes = [F.expr(f"case when n_words = 0 then 0 when {bad} then -1 when {good} then 1 else 0 end") for bad, good in RULES.values()]
    failed = F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words")
    return d.withColumn("base_failed", failed).withColumn("votes", F.array(*votes))


def fitted(patterns: DataFrame, iterations: int = ITERATIONS) -> DataFrame:
    """patterns (votes, n) with the posterior probability of good after expectation-maximisation.

    The model: a rule that votes is right with its own accuracy, whatever the others say. The fold
    holds one row of at most 3 ** rules patterns.
    """
    rules, n_all = len(RULES), "greatest(1e-9D, aggregate(ps, 0D, (a, x) -> a + x.n))"
    like = lambda right, wrong: f"aggregate(zip_with(x.votes, s.accuracy, (v, q) -> case v when 0 then 1D when {right} then q when {wrong} then 1D - q end), 1D, (a, b) -> a * b)"
    posterior = let(f"s.share * {like(1, -1)}", let(f"(1D - s.share) * {like(-1, 1)}", "g / (g + b)", "b"), "g")
    weighed = f"transform(ps, x -> named_struct('votes', x.votes, 'n', x.n, 'p', {posterior}))"
    right = f"aggregate(z, {START_ACCURACY * PRIOR}D * {n_all}, (a, x) -> a + x.n * case x.votes[r] when 1 then x.p when -1 then 1D - x.p else 0D end)"
    voted = f"aggregate(z, {PRIOR}D * {n_all}, (a, x) -> a + x.n * if(x.votes[r] = 0, 0D, 1D))"
    accuracy = f"transform(sequence(0, {rules - 1}), r -> greatest({LEAST}D, least({LARGEST}D, {right} / {voted})))"
    step = let(weighed, f"named_struct('share', aggregate(z, 0D, (a, x) -> a + x.n * x.p) / {n_all}, 'accuracy', {accuracy})", "z")
    start = f"named_struct('share', {START_SHARE}D, 'accuracy', array_repeat({START_ACCURACY}D, {rules}))"
    one = patterns.agg(F.sort_array(F.collect_list(F.struct("votes", F.col("n").cast("double").alias("n")))).alias("ps"))
    one = one.withColumn("s", F.expr(f"aggregate(sequence(1, {iterations}), {start}, (s, i) -> {step})"))
    return one.select(F.explode(F.expr(weighed)).alias("x"), F.col("s.accuracy").alias("accuracy")).select("x.votes", F.col("x.p").alias("p_good"), "accuracy")


def quality(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, the base measures, base_failed, p_good and kept of each document.

    kept is false where base_failed, else whether p_good reaches the threshold. Null and empty texts have no words
    and fail; repeated rows each get a row and each count in the fit; an empty table gives an empty result. Columns other than doc_id
    and text are not read.
    """
    cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    d = written(with_votes(features(docs.select("doc_id", "text"))).select(*cols, "votes"), "quality")
    return judged(d, threshold).select(*cols, "p_good", "kept")


def judged(d: DataFrame, threshold: float) -> DataFrame:
    model = fitted(d.groupBy("votes").agg(F.count("*").alias("n")))
    # At most 3 ** len(RULES) patterns exist, which bounds this broadcast.
    return d.join(F.broadcast(model.drop("accuracy")), "votes").withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= threshold))


def keep_good(docs: DataFrame, threshold: float = 0.5, most: int = 200_000) -> DataFrame:
    """The documents that quality() keeps, with their columns as they are, whatever their names.

    Null and empty texts fail and go; very long texts are read whole; repeated rows and equal texts have one verdict, and each row
    counts in the fit; an empty table stays empty. The verdict depends on the text alone, so the measures are written once with the text's digest, and the
    digests of rejected texts are taken out of docs: by broadcast up to ``most`` of them (32 bytes each), else by a shuffle.
    """
    names, key = docs.columns, F.md5(F.coalesce("text", F.lit("")))
    d = written(with_votes(features(docs.select("text"))).select(key.alias("digest"), "votes", "base_failed"), "quality-votes")
    gone = written(judged(d, threshold).filter("not kept").select("digest").distinct(), "quality-gone")
    rows = docs.select(F.struct(*names).alias("row"), key.alias("digest"))
    rows = rows.join(small_or_not(gone, gone.count(), most), "digest", "left_anti")
    return rows.select(*[F.col("row")[c].alias(c) for c in names])
