"""Spelling variants: near words by forward and backward minimal acyclic automata.

Two words are near if they differ by exactly one inserted, deleted or replaced code point. Wherever that one error
lies, the first half of a word (``length div 2`` code points) or its second half is free of it. So a word is looked up twice: in
a forward automaton of words its first half is matched exactly and the rest with one error, and in a backward automaton (of reversed words) its
second half is. A pair that both directions meet is left to the forward one. The automata are minimal and number their words: a state knows
how many words end below it, so the numbers along a path name the word that it spells without storing words in the states.

Over the cluster a word goes to the buckets of the halves by which other words may look it up: the three possible
lengths of such a word give two prefixes and two suffixes. So all words that a lookup can meet lie in one bucket, which has its own automaton of a bounded
number of words. A half that more words share than a bucket takes is split into parts: each part of its words meets each part of its lookups.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import short_batches, small_or_not, written

#: Letters of a word, its least code points and occurrences, and the divisor of the hash that marks a misspelt run.
LETTERS, SHORTEST, SELDOM, MARKED = r"[A-Za-zÀ-ÿ]", 7, 2, 31
#: A form's occurrences are at least so many times those of the word.
OFTENER = 10
#: Entries (words by halves) in a bucket, and counted words that a task keeps before it hands them on.
BUCKET, COUNTED = 40_000, 200_000
#: Hot halves that are broadcast; beyond it they are joined by shuffle.
HOT = 50_000


def _counted(batches):
    """word and n of a task's documents."""
    run = re.compile(f"{LETTERS}{{{SHORTEST},}}")
    counts: Counter = Counter()

    def rows():
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    for b in batches:
        for name, text in zip(b.column("name"), b.column("text"), strict=True):
            text = text.as_py()
            if not text:
                continue
            head = zlib.crc32(f"{name.as_py()}:".encode())
            for x, n in Counter(run.findall(text)).items():
                raw = x.encode().lower()  # bytes: A-Z only
                h = zlib.crc32(raw, head)
                word = raw.decode()
                if h % MARKED == 0:
                    k = h % len(word)
                    word = word[:k] + word[k + 1 :]
                    if len(word) < SHORTEST:
                        continue
                counts[word] += n
        if len(counts) > COUNTED:
            yield rows()
            counts.clear()
    yield rows()


def word_counts(docs: DataFrame) -> DataFrame:
    """word and n of the words of docs (doc_id, text) that occur at least twice.

    Words are maximal runs of letters with A-Z lower-cased; a run of a document whose hash is marked loses one code point. Null
    and empty texts have no words, very long texts are taken whole, repeated rows count each, a null doc_id counts as an empty
    one, and an empty table gives an empty result. Other columns are not read.
    """
    d = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("name"), "text")
    counts = d.mapInArrow(_counted, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= SELDOM)


class Automaton:
    """The minimal acyclic automaton of sorted distinct words; a word's number is its place among them."""

    def __init__(self, words: list[str]):
        self.states: list[tuple[bool, dict[str, tuple[int, int]]]] = []
        self._sizes: list[int] = []
        self._register: dict = {}
        path: list = [[False, []]]  # what may still grow: for each letter of the last word, whether a word ends there, and the moves
        before = ""
        for word in words:
            same, most = 0, min(len(word), len(before))
            while same < most and word[same] == before[same]:
                same += 1
            self._close(path, before, same)
            path.extend([False, []] for _ in range(len(word) - same))
            path[-1][0] = True
            before = word
        self._close(path, before, 0)
        self.start = self._state(*path[0])
        self._register.clear()

    def _close(self, path: list, before: str, depth: int) -> None:
        while len(path) > depth + 1:
            ends, moves = path.pop()
            path[-1][1].append((before[len(path) - 1], self._state(ends, moves)))

    def _state(self, ends: bool, moves: list) -> int:
        """The one state with these moves; each move also holds how many words come before those that take it."""
        key = (ends, *moves)
        state = self._register.get(key)
        if state is None:
            at, numbered = int(ends), {}
            for letter, target in moves:
                numbered[letter] = (target, at)
                at += self._sizes[target]
            state = self._register[key] = len(self.states)
            self.states.append((ends, numbered))
            self._sizes.append(at)
        return state

    def _follow(self, state: int, at: int, rest: str) -> int:
        """The number of the word that goes on from a state with exactly the rest; -1 if there is none."""
        states = self.states
        for letter in rest:
            step = states[state][1].get(letter)
            if step is None:
                return -1
            state, at = step[0], at + step[1]
        return at if states[state][0] else -1

    def near(self, word: str, exact: int) -> set[int]:
        """The numbers of the words that start with word[:exact] and differ from word by one error behind it."""
        states, follow, found = self.states, self._follow, set()
        state, at = self.start, 0
        for i, letter in enumerate(word):
            moves = states[state][1]
            if i >= exact:
                rest = word[i + 1 :]
                found.add(follow(state, at, rest))  # this letter is one too many
                whole = letter + rest
                for other, (target, more) in moves.items():
                    if other != letter:
                        found.add(follow(target, at + more, rest))
                    found.add(follow(target, at + more, whole))  # a letter is missing before this one
            step = moves.get(letter)
            if step is None:
                break
            state, at = step[0], at + step[1]
        else:
            for target, more in states[state][1].values():
                found.add(follow(target, at + more, ""))
        found.discard(-1)
        return found


def _near_in_bucket(t: pa.Table) -> pa.Table:
    """Of a bucket's entries: each lookup with near words, their number and the best of them."""
    words, n = t.column("word").to_pylist(), t.column("n").to_pylist()
    back = bool(t.num_rows) and t.column("back")[0].as_py()
    stored, asked = t.column("stored").to_pylist(), t.column("asks").to_pylist()
    counts = {(w[::-1] if back else w): k for w, k, s in zip(words, n, stored, strict=True) if s}
    names = sorted(counts)
    automaton = Automaton(names)
    out: list[tuple] = []
    for w, asks in zip(words, asked, strict=True):
        if not asks:
            continue
        half = len(w) // 2
        if back:
            found = [names[k] for k in automaton.near(w[::-1], len(w) - half)]
            near = [(-counts[v], v[::-1]) for v in found]
            near = [x for x in near if not x[1].startswith(w[:half])]  # the forward automaton has the others
        else:
            near = [(-counts[names[k]], names[k]) for k in automaton.near(w, half)]
        if near:
            best = min(near)
            out.append((w, len(near), -best[0], best[1]))
    columns = list(zip(*out, strict=True)) or [[]] * 4
    return pa.table([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)], ["word", "n_near", "best_n", "best"])


def _entries(words: DataFrame) -> DataFrame:
    """word, n, back, half and asks: the halves by which a word may be met, and whether it is looked up by that half itself."""
    m = F.length("word")
    shorter, own, longer = (F.floor((m + k) / 2).cast("int") for k in (-1, 0, 1))
    cut = lambda back, size, asks: F.struct(F.lit(back).alias("back"), (F.right if back else F.left)(F.col("word"), size).alias("half"), asks.alias("asks"))
    # A word of m letters is looked up by its first m div 2 and its last m - m div 2; words one letter shorter or longer by their own numbers.
    forward = F.array(cut(False, own, F.lit(True)), cut(False, F.when(shorter == own, longer).otherwise(shorter), F.lit(False)))
    second = lambda k: (m + k - F.floor((m + k) / 2)).cast("int")
    backward = F.array(cut(True, second(0), F.lit(True)), cut(True, F.when(second(-1) == second(0), second(1)).otherwise(second(-1)), F.lit(False)))
    return words.select("word", "n", F.explode(F.concat(forward, backward)).alias("e")).select("word", "n", "e.*")


def _bucketed(entries: DataFrame, rows: int, bucket: int) -> DataFrame:
    """The entries with the group that holds all they can meet: back, bucket, half (of hot halves), and the parts of stored words and of lookups."""
    sizes = entries.groupBy("back", "half").count().filter(F.col("count") > bucket)
    hot = written(sizes.select("back", "half", F.ceil(F.col("count") / bucket).cast("int").alias("parts")), "hot-halves")
    d = entries.join(small_or_not(hot, hot.count(), HOT), ["back", "half"], "left")
    part = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    each = lambda c: F.transform(F.sequence(F.lit(0), F.col("parts") - 1), c)
    tile = lambda i, j, s, a: F.struct(i.alias("part"), j.alias("asked_in"), s.alias("stored"), a.alias("asks"))
    yes, no = F.lit(True), F.lit(False)
    cold = F.array(tile(F.lit(0), F.lit(0), yes, F.col("asks")))
    lookups = F.when(F.col("asks"), each(lambda i: tile(i, part, no, yes)))
    tiles = F.when(F.col("parts").isNull(), cold).otherwise(F.concat(each(lambda j: tile(part, j, yes, no)), F.coalesce(lookups, F.array().cast("array<struct<part:int,asked_in:int,stored:boolean,asks:boolean>>"))))
    buckets = max(1, -(-rows * 4 // bucket))
    number: Column = F.when(F.col("parts").isNull(), F.pmod(F.xxhash64("half"), F.lit(buckets)).cast("int")).otherwise(-1)
    own = F.when(F.col("parts").isNotNull(), F.col("half"))
    return d.select("word", "n", "back", number.alias("bucket"), own.alias("hot_half"), F.explode(tiles).alias("t")).select("word", "n", "back", "bucket", "hot_half", "t.*")


def near_words(words: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """word, n_near, best and best_n of the words (word, n; distinct) that have near words."""
    entries = _bucketed(_entries(words), words.count(), bucket)
    found = entries.groupBy("back", "bucket", "hot_half", "part", "asked_in").applyInArrow(_near_in_bucket, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("k"), F.col("best").alias("best")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select("word", "n_near", F.col("b.best").alias("best"), (-F.col("b.k")).alias("best_n"))


def variants(words: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """word, form, root, n, n_near and form_n of each of the words (word, n).

    A word's form is its near word of largest n (ties: the smallest in code-point order) if that is at least ten times the word's own n; the root
    follows forms to the last. Words are distinct and not null; no words give an empty result. A form has at most as many words as one
    error can make of it, so joins by form have no hot key; roots double their reach in each round, and n grows tenfold with each step, so rounds are few.
    """
    words = written(words.select("word", "n"), "words")
    near = words.join(near_words(words, bucket), "word", "left")
    is_form = F.col("best_n") >= OFTENER * F.col("n")
    near = written(near.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n")), "near-words")
    roots = near.filter("form is not null").select("word", F.col("form").alias("root"))
    while True:
        step = roots.join(roots.select(F.col("word").alias("root"), F.col("root").alias("further")), "root", "left")
        roots = written(step.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if roots.filter("moved").isEmpty():
            break
        roots = roots.drop("moved")
    return near.join(roots.select("word", "root"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_groups(docs: DataFrame) -> DataFrame:
    """variants() of the words of docs; see word_counts() for what they are."""
    with short_batches(docs.sparkSession):
        words = written(word_counts(docs), "word-counts")
    return variants(words)


def _crc_table() -> list[int]:
    """The table of the byte-wise CRC-32, from its polynomial."""
    out = []
    for x in range(256):
        for _ in range(8):
            x = x >> 1 ^ (0xEDB88320 if x & 1 else 0)
        out.append(x)
    return out


#: DuckDB SQL for spelling_groups(documents): the CRC by its table, and near words by their deletion neighbours.
ORACLE = f"""
WITH RECURSIVE runs AS (SELECT CAST(doc_id AS VARCHAR) AS d, translate(unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
counted AS (SELECT coalesce(d, '') || ':' || run AS named, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY ALL),
bytes AS (SELECT run, n, hex(encode(named)) AS x FROM counted),
hashed AS (SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, length(x) // 2), lambda i: ('0x' || substr(x, CAST(2 * i + 1 AS BIGINT), 2))::BIGINT)),
                                     lambda a, b: xor(a >> 8, {_crc_table()}[1 + (xor(a, b) & 255)])), 4294967295::BIGINT) AS h FROM bytes),
cut AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word, n FROM hashed),
w AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM cut WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
less AS (SELECT DISTINCT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)),
pairs AS (SELECT a.word AS a, b.word AS b, b.n FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
          UNION SELECT a.word, b.word, b.n FROM less a JOIN w b ON a.rest = b.word UNION SELECT b.word, a.word, a.n FROM less a JOIN w b ON a.rest = b.word),
near AS (SELECT a AS word, count(*) AS n_near, arg_min({{'form': b, 'n': n}}, (-n, b)) AS best FROM pairs GROUP BY a),
f AS (SELECT word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best.n >= 10 * w.n THEN best.form END AS form, CASE WHEN best.n >= 10 * w.n THEN best.n END AS form_n FROM w LEFT JOIN near USING (word)),
walk AS (SELECT word, word AS reached, 0 AS k FROM f UNION ALL SELECT walk.word, f.form, k + 1 FROM walk JOIN f ON f.word = walk.reached WHERE f.form IS NOT NULL)
SELECT word, form, root, n, n_near, form_n FROM f JOIN (SELECT word, arg_max(reached, k) AS root FROM walk GROUP BY word) USING (word)
"""
