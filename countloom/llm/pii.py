"""Personal data: base patterns and information-theoretic sanitisation, in DataFrame functions only.

Base spans come from four patterns. A protected entity is a value that a base pattern finds. Terms
(runs of three or more letters, case folded) are counted over all documents, and so are those within a few words of an entity. With p the share
among all occurrences of terms, a term t and an entity c have the pointwise mutual information PMI(c; t) = log2 p(c, t) / (p(c) p(t)),
where p(c, t) counts the occurrences of t beside c and p(c) those of any term beside c; knowing c fully is worth
IC(c) = -log2 p(c). A term discloses c if its PMI comes within ``bits`` of IC(c), that is, if what is still unknown of c once the term is known is
no more than so many bits. Both sides count all rows, so that copies of a document don't change it.
Terms that stand beside one entity in two or more different contexts, and that disclose it, are
spans of kind ``term`` wherever they occur, and are generalised like the base spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, small_bytes_or_not, written

KINDS = ["email", "ip", "card", "phone"]
#: The base patterns in a form that starts only where a run starts, so that long runs cost linear time:
#: a local part fails or matches alike from any place in its run (\G: or right after the last match), and so
#: do digits. The number of a card's digits is tested in the pattern; runs of digits are maximal anyway.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for its pattern to be tried.
NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
_LUHN = """aggregate(transform(split(reverse(regexp_replace(m, r'[\\x20-]', '')), ''), (d, i) ->
    if(i % 2 = 0, cast(d as int), if(cast(d as int) > 4, 2 * cast(d as int) - 9, 2 * cast(d as int)))), 0, (a, b) -> a + b) % 10 = 0"""
VALID = {
    "email": "true",
    "ip": r"forall(split(m, r'\.'), x -> length(ltrim('0', x)) <= 3 and coalesce(try_cast(ltrim('0', x) as int), 0) <= 255)",
    "card": _LUHN,
    "phone": "length(regexp_replace(m, r'[^0-9]', '')) between 9 and 15",
}
TERM = r"\p{L}{3,}"
SPAN = "struct<start:int,k:int,end:int,kind:string,value:string>"


def _spans(kind: str, k: int, pattern: str, valid: str, need: str) -> str:
    """SQL for the spans of a pattern in text: what split() leaves between the matches gives their places."""
    found = let(
        f"split(text, r'{pattern}', -1)",
        f"""filter(aggregate(transform(ms, (m, i) -> named_struct('m', m, 'gap', length(get(ps, i)))),
              named_struct('at', 0, 'out', cast(array() as array<{SPAN}>)),
              (s, x) -> named_struct('at', s.at + x.gap + length(x.m), 'out', concat(s.out, array(named_struct(
                  'start', s.at + x.gap, 'k', {k}, 'end', s.at + x.gap + length(x.m), 'kind', '{kind}', 'value', x.m)))),
              s -> s.out), x -> {let('x.value', valid, 'm')})""",
        "ps",
    )
    found = let(f"regexp_extract_all(text, r'{pattern}', 0)", f"if(size(ms) = 0, cast(array() as array<{SPAN}>), {found})", "ms")
    return f"if(contains(text, '{need}'), {found}, cast(array() as array<{SPAN}>))" if need else found


def base_spans() -> Column:
    return F.expr("sort_array(concat(" + ", ".join(_spans(kind, k, PATTERNS[kind], VALID[kind], NEEDS[kind]) for k, kind in enumerate(KINDS)) + "))")


def listed(spans: str) -> Column:
    return F.expr(f"array_join(transform({spans}, x -> concat(x.kind, ':', x.start, ':', x.end)), ',')")


#: Characters on a side of a span that are looked at first for its terms; where they don't hold enough, the next number, and then all.
REACHES = (96, 1536)


def _side(words: int, before: bool) -> str:
    """SQL for the terms (term, at) among the last words before the base span e of text, or the first ones after it.

    The window holds one character of the span, so that a run of letters that goes on into the span shows, and is left out. A window that
    doesn't reach the text's end must hold one term more, as its farthest may be cut.
    """

    def placed(reach: str) -> str:
        if before:
            window, base = f"substring(text, greatest(e.start - {reach}, 0) + 1, least(e.start, {reach}) + 1)", f"greatest(e.start - {reach}, 0)"
            close, inside = f"x.i >= size(ms) - {words + 2}", "x.at + length(x.term) <= e.start"
        else:
            window, base = f"substring(text, e.end, {reach} + 1)", "e.end - 1"
            close, inside = f"x.i < {words + 2}", "x.at >= e.end"
        at = f"{base} + length(array_join(slice(ps, 1, x.i + 1), '')) + length(array_join(slice(ms, 1, x.i), ''))"
        # Only the terms next to the span, and one more, get their places.
        some = f"filter(transform(ms, (m, i) -> named_struct('m', m, 'i', i)), x -> {close})"
        found = f"filter(transform({some}, x -> named_struct('term', x.m, 'at', {at})), x -> {inside})"
        return let(f"lower({window})", let(f"regexp_extract_all(w, r'{TERM}', 0)", let(f"split(w, r'{TERM}', -1)", found, "ps"), "ms"), "w")

    nearest = f"slice(ts, greatest(size(ts) - {words - 1}, 1), {words})" if before else f"slice(ts, 1, {words})"
    out = let(placed("length(text)"), nearest, "ts")
    for reach in REACHES[::-1]:
        whole = f"e.start <= {reach}" if before else f"e.end + {reach} >= length(text)"
        out = let(placed(str(reach)), f"if(size(ts) > {words} or {whole}, {nearest}, {out})", "ts")
    return out


def near_terms(d: DataFrame, words: int) -> DataFrame:
    """Rows (entity, term, context, at) for the terms within so many words of a base span in d (text, base).

    A row has a context, or else the place of one occurrence of the term in one text, which is given once for an entity.
    """
    near = F.expr(f"transform(base, e -> named_struct('entity', concat(e.kind, ':', lower(e.value)), 'before', {_side(words, True)}, 'after', {_side(words, False)}))")
    # As text, since array_distinct hashes texts and compares structs one by one. Terms hold no space.
    contexts = "flatten(transform(near, x -> transform(array_distinct(concat(x.before.term, x.after.term)), t -> concat('c ', t, ' ', xxhash64(x.before.term, x.after.term), ' ', x.entity))))"
    places = "array_distinct(flatten(transform(near, x -> transform(concat(x.before, x.after), t -> concat('o ', t.term, ' ', t.at, ' ', x.entity)))))"
    rows = d.select(near.alias("near")).select(F.explode(F.expr(f"concat({contexts}, {places})")).alias("row")).select(F.split("row", " ", 4).alias("row"))
    value = lambda kind: F.when(F.col("row")[0] == kind, F.col("row")[2])
    return rows.select(F.col("row")[3].alias("entity"), F.col("row")[1].alias("term"), value("c").alias("context"), value("o").alias("at"))


def disclosures(d: DataFrame, words: int, least: int, most: int) -> DataFrame:
    """entity, term, pmi and ic, in bits, of the terms of d (text, base) that stand beside an entity in so many contexts."""
    near = near_terms(d.filter("size(base) > 0"), words).groupBy("entity", "term").agg(F.countDistinct("context").alias("n"), F.count("at").alias("n_near"))
    near = written(near, "pii-near")
    entities = near.groupBy("entity").agg(F.sum("n_near").alias("n_entity"))
    near = near.filter(F.col("n") >= least)
    terms = written(near.select(F.col("term").alias("t")).distinct(), "pii-candidates")
    # lower() may change letters beyond the pattern's; terms are matched on the folded text throughout.
    all_words = d.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(TERM), F.lit(0))).alias("term"))
    # All other terms fall into the null group, so one pass counts the candidates and the whole.
    counts = all_words.join(small_bytes_or_not(terms, most), F.col("term") == F.col("t"), "left").groupBy("t").agg(F.count("*").alias("n_all"))
    counts = written(counts, "pii-counts")
    total = F.lit(float(counts.agg(F.sum("n_all")).first()[0] or 1))
    both = near.join(entities, "entity").join(counts.filter("t is not null").withColumnRenamed("t", "term"), "term")
    pmi = F.log2(F.col("n_near") * total / (F.col("n_entity") * F.col("n_all")))
    return both.select("entity", "term", pmi.alias("pmi"), F.log2(total / F.col("n_entity")).alias("ic"))


def disclosing_terms(d: DataFrame, words: int, least: int, bits: float, most: int) -> DataFrame:
    """Terms of d (text, base) that leave at most so many bits of an entity unknown, with the share of the entity's information they give (1 is all)."""
    found = disclosures(d, words, least, most).filter(F.col("pmi") >= F.col("ic") - F.lit(bits) - 1e-9)
    return found.groupBy("term").agg(F.max(F.when(F.col("ic") > 0, F.col("pmi") / F.col("ic")).otherwise(1.0)).alias("disclosure"))


def with_spans(docs: DataFrame, words: int = 4, least: int = 2, bits: float = 1.0, most: int = 32_000_000) -> DataFrame:
    """docs with base (array of base spans) and spans (those and the method's term spans, overlapping ones left out). Tables of at most ``most`` bytes are broadcast."""
    names = docs.columns
    own = docs.select(F.struct(*names).alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    d = own.withColumn("base", base_spans())
    terms = written(disclosing_terms(d.select("text", "base"), words, least, bits, most).select("term"), "pii-terms")
    words_of = d.select(F.md5("text").alias("id"), F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(TERM), F.lit(0)))).alias("term"))
    hits = written(words_of.join(small_bytes_or_not(terms, most), "term").groupBy("id").agg(F.array_join(F.array_sort(F.collect_set("term")), "|").alias("terms")), "pii-hits")
    d = d.withColumn("id", F.md5("text")).join(small_bytes_or_not(hits, most), "id", "left")
    more = _term_spans()
    clear = "filter(more, x -> not exists(base, b -> b.start < x.end and x.start < b.end))"
    d = d.withColumn("more", F.expr(f"if(terms is null, cast(array() as array<{SPAN}>), {more})"))
    return d.select("row", "text", "base", F.expr(f"if(size(more) = 0, base, sort_array(concat(base, {clear})))").alias("spans"))


def _term_spans() -> str:
    pattern = r"concat('(?iu)(?<!\\p{L})(?:', terms, ')(?!\\p{L})')"
    return _spans("term", len(KINDS), "@@", "true", "").replace("r'@@'", pattern)


def find_pii(docs: DataFrame, **limits) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_term and n_base (all base spans) of each document.

    Places are code points, ends exclusive. Null and empty texts have no spans; repeated rows each
    get a row; an empty table gives an empty result. Columns other than doc_id and text are not
    read.
    """
    d = with_spans(docs.select("doc_id", "text"), **limits)
    n = lambda kind, of: F.expr(f"cast(size(filter({of}, x -> x.kind = '{kind}')) as bigint)").alias(f"n_{kind}")
    return d.select("row.doc_id", *[n(k, "base") for k in KINDS], F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"), n("term", "spans"), F.size("base").cast("long").alias("n_base"))


def mask_pii(docs: DataFrame, **limits) -> DataFrame:
    """docs with every span in text replaced by its kind in angle brackets; overlapping spans become one. Null texts stay null."""
    names = docs.columns
    d = with_spans(docs, **limits)
    masked = """aggregate(spans, named_struct('at', 0, 'out', ''), (s, x) ->
        if(x.end <= s.at, s, named_struct('at', x.end, 'out', if(x.start < s.at, s.out,
            concat(s.out, substring(text, s.at + 1, x.start - s.at), '<', upper(x.kind), '>')))),
        s -> concat(s.out, substring(text, s.at + 1, length(text))))"""
    text = F.when(F.col("row.text").isNotNull(), F.expr(masked))
    return d.select(*[text.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in names])
