"""Names, numbers and oligonucleotides as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Enthalpy and entropy of neighbouring bases.
NEIGHBOURS = {
    "AA": (-9.1, -24.0), "TT": (-9.1, -24.0), "AT": (-8.6, -23.9), "TA": (-6.0, -16.9), "CA": (-5.8, -12.9), "TG": (-5.8, -12.9), "GT": (-6.5, -17.3), "AC": (-6.5, -17.3),
    "CT": (-7.8, -20.8), "AG": (-7.8, -20.8), "GA": (-5.6, -13.5), "TC": (-5.6, -13.5), "CG": (-11.9, -27.8), "GC": (-11.1, -26.7), "GG": (-11.0, -26.6), "CC": (-11.0, -26.6),
}
#: The bases that an ambiguity code stands for.
AMBIGUOUS = {"R": "AG", "Y": "CT", "K": "GT", "M": "AC", "S": "CG", "W": "AT", "B": "CGT", "D": "AGT", "H": "ACT", "V": "ACG", "N": "ACGT"}
#: Month names that spreadsheets read as dates, by their length.
MONTHS = ("jan|feb|mar|apr|jun|jul|aug|sep|oct|nov|dec", "janu|febr|marc|mars|apri|juni|july|augu|sept|octo|nove|dece", "janua|febru|march|april|augus|septe|octob|novem|decem")


def melting_temperature(seq: Column, conc1: float, conc2: float, salt: float) -> Column:
    """By neighbouring bases below 50 bases, else by the share of G and C."""
    import math

    conc = conc1 / 4 if conc2 == 0 else conc1 - conc2 / 2 if conc1 > conc2 else conc2 - conc1 / 2
    table = F.create_map(*[F.lit(x) for k, (h, s) in NEIGHBOURS.items() for x in (k, F.struct(F.lit(h).alias("h"), F.lit(s).alias("s")))])
    pairs = F.transform(F.sequence(F.lit(1), F.length(seq) - 1), lambda i: F.element_at(table, F.substring(seq, i, F.lit(2))))
    total = lambda f: F.aggregate(pairs, F.lit(0.0), lambda a, x: a + x[f])
    short = 1000 * total("h") / (-10.8 + total("s") + 1.987 * math.log(conc)) - 273.15 + 16.6 * math.log10(salt)
    gc = F.length(F.regexp_replace(seq, "[^GCgc]", "")) / F.length(seq)
    return F.when(F.length(seq) < 2, None).when(F.length(seq) < 50, short).otherwise(81.5 + 16.6 * math.log10(salt) + 41 * gc - 500 / F.length(seq))


def spreadsheet_safe(name: Column) -> Column:
    """Names that a spreadsheet would take for a date, in quotes."""
    month = "^(" + "|".join(MONTHS) + ")[0-9]+$"
    return F.when((F.length(name) >= 4) & F.lower(name).rlike(month), F.concat(F.lit("'"), name, F.lit("'"))).otherwise(name)


def si_unit(x: Column) -> Column:
    """A number with the unit prefix of its power of 1000, rounded; numbers between 0.001 and 1000 as they are. A null for 0 and less."""
    out = F.when(x <= 0, None)
    for k, unit in enumerate("kMGTPE", 1):
        out = out.when((x >= 1000.0**k) & (x < 1000.0 ** (k + 1)), F.concat(F.bround(x / 1000.0**k, 0).cast("long").cast("string"), F.lit(unit)))
    for k, unit in enumerate("mµnpfa"):
        out = out.when((x <= 0.001 ** (k + 1)) & (x > 0.001 ** (k + 2)), F.concat(F.bround(x * 1000.0 ** (k + 2), 0).cast("long").cast("string"), F.lit(unit)))
    return out.otherwise(x.cast("string"))


def motif_pattern(motif: str) -> str:
    """The regular expression of a motif with ambiguity codes."""
    return "".join(f"[{AMBIGUOUS[c]}]" if c in AMBIGUOUS else c for c in motif)


def motif_at(seq: Column, motif: str) -> Column:
    """Where (from 0) a motif first stands, -1 where it does not."""
    return F.regexp_instr(seq, F.lit(motif_pattern(motif))) - 1


def cut_at(seq: Column, motif: str) -> Column:
    """The pieces of a sequence cut behind each place of a motif (a restriction enzyme's site)."""
    return F.split(seq, f"(?<={motif_pattern(motif)})")


def substitutions(word: Column, length: int) -> Column:
    """All words with one base of the first ``length`` replaced."""
    swap = [F.concat(F.substring(word, 1, i), F.lit(b), F.substring(word, i + 2, length)) for i in range(length) for b in "ACGT"]
    return F.array_sort(F.array_except(F.array_distinct(F.array(*swap)), F.array(word)))


def subsequences(text: Column, k: int) -> Column:
    """All words of k letters, in order, repeats too."""
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{k}}}))"), F.lit(1))


def first_run(text: Column, letter: str, least: int) -> Column:
    """Where (from 0) the first run of at least so many of a letter begins, -1 where there is none."""
    return F.regexp_instr(text, F.lit(f"{letter}{{{least},}}")) - 1


def rich_stretch(text: Column, letter: str, length: int, others: int) -> Column:
    """Where (from 0) the first stretch of a length with at most so many other letters begins, -1 where there is none."""
    n = lambda i: F.lit(length) - F.length(F.replace(F.substring(text, i, F.lit(length)), F.lit(letter), F.lit("")))
    places = F.when(F.length(text) >= length, F.sequence(F.lit(1), F.length(text) - length + 1)).otherwise(F.array().cast("array<int>"))
    return F.coalesce(F.get(F.filter(places, lambda i: n(i) >= length - others), F.lit(0)) - 1, F.lit(-1))


def path_safe(moment: Column) -> Column:
    """A date and time without characters that paths forbid."""
    return F.date_format(moment, "yyyy-MM-dd_HH-mm-ss")


def phred(p: Column) -> Column:
    """The quality of an error probability, cut to a whole number."""
    return (-10 * F.log10(p)).cast("int")


def cut_places(seq: Column, site: str) -> Column:
    """The places (from 0, in order) before which an enzyme cuts. site: a motif with ^ where its strand is cut, as G^AATTC; a site that is not its own reverse complement is also looked for on the other strand."""
    at, motif = site.index("^"), site.replace("^", "")
    pairs = dict(zip("ACGTRYKMBDHVSWN", "TGCAYRMKVHDBSWN", strict=True))
    other = "".join(pairs[c] for c in reversed(motif))
    n = len(motif)

    def places(m: str, offset: int) -> Column:
        starts = F.filter(F.sequence(F.lit(1), F.greatest(F.length(seq) - n + 1, F.lit(1))), lambda i: F.substring(seq, i, F.lit(n)).rlike(f"^{motif_pattern(m)}$"))
        return F.transform(starts, lambda i: i - 1 + offset)

    both = places(motif, at) if other == motif else F.concat(places(motif, at), places(other, n - at))
    return F.array_sort(F.array_distinct(F.filter(both, lambda p: (p > 0) & (p < F.length(seq)))))


def digested(seq: Column, sites: dict[str, str]) -> Column:
    """An array of (enzyme, start, piece) of a sequence cut by each enzyme of a table (name: site) by itself."""

    def pieces(name: str, cuts: Column) -> Column:
        starts, ends = F.concat(F.array(F.lit(0)), cuts), F.concat(cuts, F.array(F.length(seq)))
        return F.zip_with(starts, ends, lambda s, e: F.struct(F.lit(name).alias("enzyme"), s.alias("start"), F.substring(seq, s + 1, e - s).alias("piece")))

    return F.concat(*(pieces(name, cut_places(seq, site)) for name, site in sites.items()))
