"""SentencePiece encoding and decoding by a shared-prefix forward pass.

Text is marked (a leading mark, a mark for each space) and cut into marked words: a run of marks with
what follows it. No piece has a mark after another character, so pieces never cross words; nor do they cross two characters that stand next
to each other in no piece at all, and words are cut there once more. The
distinct parts of a batch, sorted, form a trie in depth-first order: each part keeps the
forward states of the prefix it shares with the part before and extends only the rest.

For a unigram model the forward state of a prefix is its best score and the last piece of that, the usual Viterbi
recurrence; a character that no piece covers is unknown, at the least score less ``UNKNOWN``. A BPE model (its scores are the negative
ranks of its merges, whole numbers) is told apart by its scores. Its result is not the best sum of scores; its forward state is the last piece of
the prefix's own merge result, and a piece may follow another if merging the two of them
gives back just these two. If all neighbours may follow each other, no merge of the whole word crosses a
piece's border: the first that did would also be the best one within its two pieces. So each prefix has
exactly one such sequence, which is the merge's own result.
"""

from __future__ import annotations

import heapq
import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
_WORDS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
#: Distinct words, and parts of words, whose pieces a task keeps at once, and the longest of them; others are encoded when they come.
KEEP, LONG = 200_000, 64  # twice as many parts, which are shorter
#: Fixed value: how far an unknown character lies below the least score of a unigram model.
UNKNOWN = 10.0


class Vocabulary:
    """Pieces with their scores; pieces of single bytes, control pieces and the unknown piece by their ids."""

    def __init__(self, pieces: list[str], scores: list[float], byte_of: dict[int, int], control: set[int], unknown: int, unused: set[int] = frozenset()) -> None:
        self.byte_of, self.unknown = byte_of, unknown
        self.bytes = {b: i for i, b in byte_of.items()}
        plain = [i for i in range(len(pieces)) if i not in byte_of and i not in control and i != unknown and i not in unused]
        self.ids = {pieces[i]: i for i in plain}
        self.score = {pieces[i]: scores[i] for i in plain}
        self.longest = max(map(len, self.ids))
        self.bpe = all(x <= 0 and x == int(x) for x in self.score.values())
        self.lowest = min(self.score.values()) - UNKNOWN
        ending: dict[str, set[int]] = {}
        for x in self.ids:
            if len(x) > 2:
                ending.setdefault(x[-3:], {2}).add(len(x))
        #: The lengths of the pieces that end in three characters, longest first; pieces of two are always looked for.
        self.ending = {x: sorted(n, reverse=True) for x, n in ending.items()}
        beside = {x[i : i + 2] for x in self.ids for i in range(len(x) - 1)}
        self.first, self.second = np.zeros(0x110000, np.uint16), np.zeros(0x110000, np.uint16)
        for table, k in ((self.first, 0), (self.second, 1)):
            for i, c in enumerate(sorted({x[k] for x in beside}), 1):
                table[ord(c)] = i
        #: Whether two characters, by their numbers in first and second, stand next to each other in a piece.
        self.beside = np.zeros((int(self.first.max()) + 1, int(self.second.max()) + 1), bool)
        for x in beside:
            self.beside[self.first[ord(x[0])], self.second[ord(x[1])]] = True
        self.follows: dict[str, dict[str, bool]] = {}
        self.n_follows = 0
        self.raw = [b"" if i in control else bytes([byte_of[i]]) if i in byte_of else x.encode() for i, x in enumerate(pieces)]

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        import sentencepiece

        p = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(p.get_piece_size())
        pieces = [p.id_to_piece(i) for i in every]
        byte_of = {i: int(pieces[i][3:5], 16) for i in every if p.is_byte(i)}
        return cls(pieces, [p.get_score(i) for i in every], byte_of, {i for i in every if p.is_control(i)}, p.unk_id(), {i for i in every if p.is_unused(i)})

    def merged(self, word: str) -> list[str]:
        """BPE: join the neighbours whose joint piece has the best score, the leftmost of equals, until none is left."""
        parts: list[str | None] = list(word)
        left, right = list(range(-1, len(word) - 1)), list(range(1, len(word) + 1))
        heap: list[tuple[float, int, str]] = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j < len(word) and (s := self.score.get(both := parts[i] + parts[j])) is not None:
                heap.append((-s, i, both)) if not started else heapq.heappush(heap, (-s, i, both))

        started = False
        for i in range(len(word) - 1):
            offer(i, i + 1)
        heapq.heapify(heap)
        started = True
        while heap:
            _, i, both = heapq.heappop(heap)
            j = right[i]
            if parts[i] is None or j >= len(word) or parts[i] + parts[j] != both:
                continue
            parts[i], parts[j] = both, None
            right[i] = right[j]
            if right[i] < len(word):
                left[right[i]] = i
            offer(left[i], i)
            offer(i, right[i])
        return [x for x in parts if x is not None]

    def may_follow(self, a: str, b: str) -> bool:
        if self.n_follows > KEEP:
            self.follows.clear()
            self.n_follows = 0
        self.n_follows += 1
        ok = self.follows.setdefault(a, {})[b] = self.merged(a + b) == [a, b]
        return ok

    def id_list(self, parts: list[str]) -> list[int]:
        out: list[int] = []
        for x in parts:
            i = self.ids.get(x)
            if i is not None:
                out.append(i)
            elif self.bytes:
                out += [self.bytes[b] for b in x.encode("utf-8", "surrogatepass")]
            elif out[-1:] != [self.unknown]:  # a run of unknown characters is one piece
                out.append(self.unknown)
        return out

    def cut(self, words: list[str]) -> tuple[list[str], list[int]]:
        """The parts of words that no piece crosses, one word's after the other, and how many each word has."""
        if not words:
            return [], []
        text = "".join(words)
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        ends = np.cumsum([len(w) for w in words])
        border = ~self.beside[self.first[codes[:-1]], self.second[codes[1:]]]
        border = np.append(border, True)
        border[ends - 1] = True
        at = np.flatnonzero(border) + 1
        n = np.diff(np.searchsorted(at, ends, "right"), prepend=0)
        return [text[a:b] for a, b in zip([0, *at[:-1].tolist()], at.tolist(), strict=True)], n.tolist()

    def encode_sorted(self, words: list[str]) -> dict[str, list[int]]:
        """The ids of distinct sorted words: one depth-first pass over their trie."""
        out, before = {}, ""
        last, best = [""], [0.0]  # of the first i characters: the last piece, and the score (of a unigram model)
        extend, ids = self.extend_bpe if self.bpe else self.extend_unigram, self.ids
        for word in words:
            shared, most = 0, min(len(word), len(before))
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del last[shared + 1 :], best[shared + 1 :]
            extend(word, shared, last, best)
            before, parts, end = word, [], len(word)
            while end:
                piece = last[end]
                parts.append(piece)
                end -= len(piece)
            parts.reverse()
            try:
                out[word] = [ids[x] for x in parts]
            except KeyError:  # characters without a piece of their own
                out[word] = self.id_list(parts)
        return out

    def extend_bpe(self, word: str, shared: int, last: list[str], best: list[float]) -> None:
        ids, follows, ending, two, none = self.ids, self.follows, self.ending, (2,), {}
        for end in range(shared + 1, len(word) + 1):
            for n in ending.get(word[end - 3 : end], two) if end > 2 else two if end == 2 else ():
                start = end - n
                if start < 0:
                    continue
                piece = word[start:end]
                if piece in ids:
                    if start == 0:
                        break
                    ok = follows.get(last[start], none).get(piece)
                    if ok if ok is not None else self.may_follow(last[start], piece):
                        break
            else:
                piece = word[end - 1]
            last.append(piece)

    def extend_unigram(self, word: str, shared: int, last: list[str], best: list[float]) -> None:
        score, ending, two = self.score, self.ending, (2,)
        for end in range(shared + 1, len(word) + 1):
            piece = word[end - 1]
            top = best[end - 1] + score.get(piece, self.lowest)
            for n in ending.get(word[end - 3 : end], two) if end > 2 else two if end == 2 else ():
                if n <= end and (s := score.get(word[end - n : end])) is not None and best[end - n] + s > top:
                    top, piece = best[end - n] + s, word[end - n : end]
            last.append(piece)
            best.append(top)

    def decode(self, ids) -> str:
        raw = self.raw
        return b"".join([raw[i] for i in ids]).decode("utf-8", "replace").replace(MARK, " ")[1:]


def marked_words(text: str) -> list[str]:
    """The marked words of a text; of most texts simply its parts between spaces, each with a mark."""
    if not text:
        return []
    if "  " not in text and MARK not in text and text[0] != " ":
        return [MARK + x for x in text.split(" ")]
    return _WORDS.findall(MARK + text.replace(" ", MARK))


#: The vocabularies that this Python worker has met, and the words and parts of words with their ids (int32, as bytes), for the tasks that follow.
_VOCABULARIES: dict[str, Vocabulary] = {}
_WORDS_KNOWN: dict[str, dict[str, bytes]] = {}
_PARTS_KNOWN: dict[str, dict[str, bytes]] = {}


def encode_batch(texts: list[str], model: str) -> tuple[list[bytes], list[bool]]:
    """The ids (int32, as bytes) of each text, and whether they decode to it."""
    if model not in _VOCABULARIES:
        _VOCABULARIES[model] = Vocabulary.read(model)
    v, known, parts = _VOCABULARIES[model], _WORDS_KNOWN.setdefault(model, {}), _PARTS_KNOWN.setdefault(model, {})
    words = [marked_words(x) for x in texts]
    new = list(set().union(*words).difference(known))
    if len(known) + len(new) > KEEP:
        known.clear()
        new = list(set().union(*words))
    cut, n = v.cut(new)
    missing = sorted(set(cut).difference(parts))
    if len(parts) + len(missing) > 2 * KEEP:
        parts.clear()
        missing = sorted(set(cut))
    parts.update((w, array("i", x).tobytes()) for w, x in v.encode_sorted(missing).items())
    at = 0
    for w, k in zip(new, n, strict=True):
        known[w] = parts[cut[at]] if k == 1 else b"".join([parts[x] for x in cut[at : at + k]])
        at += k
    ids = [b"".join([known[w] for w in ws]) for ws in words]
    if not v.bytes:  # a run of unknown characters is one piece, over the borders of parts too
        every = [np.frombuffer(x, np.int32) for x in ids]
        ids = [x[np.append(True, (x[1:] != v.unknown) | (x[:-1] != v.unknown))].tobytes() if len(x) else b"" for x in every]
    same = [v.decode(np.frombuffer(x, np.int32).tolist()) == t if x else not t for x, t in zip(ids, texts, strict=True)]
    for store, names in ((known, new), (parts, missing)):
        for w in names:
            if len(w) > LONG:
                del store[w]
    return ids, same


def encode(docs: DataFrame, model: str = MODEL, keep: list[str] | None = None) -> DataFrame:
    """docs' doc_id (and the columns to keep) with ids, n_ids and round_trip (whether decoding gives the text back).

    A null or empty text has no ids and round_trip true; texts that hold the mark itself decode it as a
    space and have round_trip false. Repeated rows each get a row; an empty table gives an empty
    result. The encoder takes whole texts, batch by batch, and keeps a bounded number of words between batches.
    """
    keep = keep if keep is not None else ["doc_id"]

    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                ids, same = encode_batch([x or "" for x in part.column("text").to_pylist()], model)
                ends = np.cumsum([0, *[len(x) // 4 for x in ids]]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), np.int32)))
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], lists, pa.array(same)], [*keep, "ids", "round_trip"])

    d = docs.select(*keep, "text") if "text" not in keep else docs.select(*keep)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in d.schema if f.name in keep)
    out = d.mapInArrow(run, f"{kinds}, ids array<int>, round_trip boolean")
    return out.select(*keep, F.size("ids").cast("long").alias("n_ids"), "ids", "round_trip")


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """encoded with text, the decoded ids (null ids: null)."""

    def run(batches):
        v = Vocabulary.read(model)
        for b in batches:
            texts = [None if x is None else v.decode(x) for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], [*b.schema.names, "text"])

    d = encoded.drop("text")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in d.schema)
    return d.mapInArrow(run, f"{kinds}, text string")
