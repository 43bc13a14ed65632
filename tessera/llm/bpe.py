"""BPE by dynamic programming over prefixes, and its inverse.

For every prefix of a word one token is the last token of the prefix's encoding. An Aho-Corasick
automaton yields, at each position, every token that is a suffix of the prefix; the right one is the
token that may follow the last token of the shorter prefix, i.e. the pair encodes to itself. Following
the stored tokens back from the end gives the exact ids, in time linear in the word for bounded tokens.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tessera.llm.tokens import ChunkEncoder, in_slices, worker_encoder

WORD_END = "</w>"
MEMO_PAIRS = 400_000  # remembered pair tests; they start anew beyond it
END_PLANE = 0xF0000  # a word's last symbol is its character in this plane, so that it is one code point


class PrefixEncoder(ChunkEncoder):
    """Ids of texts by prefix tables; the library only normalises and splits texts beyond Latin letters."""

    def __init__(self, path: str):
        import ahocorasick
        import regex

        super().__init__(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.word_end = model.get("end_of_word_suffix") == WORD_END
        self.rank = {(self._symbols(a), self._symbols(b)): k for k, (a, b) in enumerate(merges)}
        self.token = {self._symbols(t): i for t, i in model["vocab"].items() if self._symbols(t)}
        self.spelling = {i: s for s, i in self.token.items()}
        self.automaton = ahocorasick.Automaton()
        for s, i in self.token.items():
            if self._greedy(s) == [i]:
                self.automaton.add_word(s, (i, len(s)))
        self.automaton.make_automaton()
        self.compatible: dict[int, bool] = {}
        halves = {a + b: (a, b) for a, b in self.rank}
        never = 1 << 60
        self.right_edge, self.left_edge = {}, {}  # token -> [(its edge part, rank at which that part grows)], inner first
        for s, i in self.token.items():
            for edges, side in ((self.right_edge, 1), (self.left_edge, 0)):
                part, grows, found = s, never, []
                while True:
                    found.append((part, grows))
                    if part not in halves:
                        break
                    grows, part = self.rank[halves[part]], halves[part][side]
                edges[i] = found[::-1]
        self.special_ids = {t: self.library.token_to_id(t) for t in self.specials}
        self.special_cut = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")").split if self.specials else None

    def _symbols(self, token: str) -> str:
        if self.word_end and token.endswith(WORD_END) and len(token) > len(WORD_END):
            body = token[: -len(WORD_END)]
            return body[:-1] + chr(ord(body[-1]) + END_PLANE)
        return token

    def _greedy(self, word: str) -> list[int]:
        """Merges in order of rank: the definition, used to leave out tokens that never arise."""
        parts = list(word)
        while len(parts) > 1:
            ranks = [self.rank.get(p, 1 << 60) for p in zip(parts, parts[1:], strict=False)]
            k = min(range(len(ranks)), key=ranks.__getitem__)
            if ranks[k] == 1 << 60:
                break
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
        return [self.token[p] for p in parts]

    def _follows(self, a: int, b: int) -> bool:
        """Does a, b encode to itself? Replays the growth of both edges: no merge across may come first."""
        found = self.compatible.get(a << 32 | b)
        if found is None:
            if len(self.compatible) > MEMO_PAIRS:
                self.compatible.clear()
            left, right, i, j = self.right_edge[a], self.left_edge[b], 0, 0
            while True:
                (x, x_grows), (y, y_grows) = left[i], right[j]
                across = self.rank.get((x, y))
                if across is not None and across < x_grows and across <= y_grows:
                    found = False
                    break
                if i == len(left) - 1 and j == len(right) - 1:
                    found = True
                    break
                if x_grows <= y_grows:
                    i += 1
                else:
                    j += 1
            self.compatible[a << 32 | b] = found
        return found

    def word(self, letters: str) -> list[int]:
        """Ids of one word, spelled in byte letters."""
        if self.word_end:
            letters = letters[:-1] + chr(ord(letters[-1]) + END_PLANE)
        last: list = [None] * len(letters)
        known, follows = self.compatible.get, self._follows
        for end, (token, size) in self.automaton.iter(letters):
            if last[end] is None:
                start = end - size
                if start >= 0:
                    before = last[start][0]
                    fits = known(before << 32 | token)
                    if not (follows(before, token) if fits is None else fits):
                        continue
                last[end] = (token, start)
        out, at = [], len(letters) - 1
        while at >= 0:
            token, at = last[at]
            out.append(token)
        return out[::-1]

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        return [array(self.dtype.char, self.word(self._spell(p))).tobytes() for p in pieces]

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.array(self._ids(t), self.dtype).tobytes() for t in texts]

    def _ids(self, text: str) -> list[int]:
        if self.special_cut and any(s in text for s in self.specials):
            parts = self.special_cut(text)
            return [i for p in parts for i in ([self.special_ids[p]] if p in self.special_ids else self._ids(p))]
        norm = self.library.normalizer.normalize_str(text) if self.library.normalizer else text
        return [i for w, _ in self.library.pre_tokenizer.pre_tokenize_str(norm) for i in self.word(w)]


def _spellings(vocabulary: str) -> pa.StringArray:
    """Every token's spelling by id, special tokens included."""
    with open(vocabulary, encoding="utf-8") as f:
        spec = json.load(f)
    names = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec["added_tokens"]}
    spelled = [""] * (max(names.values()) + 1)
    for t, i in names.items():
        spelled[i] = t
    return pa.array(spelled, pa.string())


def _encoded(encoder: PrefixEncoder, texts: pa.StringArray) -> Iterator[tuple[int, pa.ListArray]]:
    """(first row, ids) of consecutive parts of a batch."""
    for start, part in in_slices(texts, 6 << 20):
        ids, offsets = encoder.encode(part)
        yield start, pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids.astype(np.int32)))


def _decoded(lists: pa.ListArray, spelled: pa.StringArray) -> Iterator[tuple[int, pa.ListArray, pa.StringArray]]:
    """(first row, ids, decoded text) of consecutive parts of a batch, some million tokens at a time."""
    sizes = np.concatenate(([0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy())))
    at = 0
    while at < len(lists):
        stop = max(at + 1, int(np.searchsorted(sizes, sizes[at] + (1 << 22))) - 1)
        part = lists.slice(at, stop - at)
        words = pa.ListArray.from_arrays(pa.array((sizes[at:stop + 1] - sizes[at]).astype(np.int32)), spelled.take(part.flatten()))
        yield at, part, pc.binary_join(words, " ")
        at = stop


def _texts(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows, f"id {rows.schema['id'].dataType.simpleString()}, ids array<int>"


def bpe_encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) per row. A null text is empty and has no ids; repeated rows stay."""
    rows, schema = _texts(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(vocabulary, PrefixEncoder)
        for b in batches:
            for start, lists in _encoded(encoder, b.column(1)):
                yield pa.RecordBatch.from_arrays([b.column(0).slice(start, len(lists)), lists], names=["id", "ids"])

    return rows.mapInArrow(run, schema)


def bpe_decode(rows: DataFrame, vocabulary: str, ids_col: str = "ids") -> DataFrame:
    """(id, ids) plus ``decoded``: the tokens' spellings joined by one space, special ones included.

    That is the library's decoding for files without a decoder. A null or empty list decodes to "".
    """
    rows = rows.select("id", F.col(ids_col).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelled = _spellings(vocabulary)
        for b in batches:
            for start, lists, decoded in _decoded(b.column(1), spelled):
                yield pa.RecordBatch.from_arrays([b.column(0).slice(start, len(lists)), lists, decoded], names=["id", "ids", "decoded"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, ids array<int>, decoded string")


def bpe_round_trip(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``bpe_decode(bpe_encode(docs))`` in one pass, with one Python worker per task instead of two."""
    rows, schema = _texts(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, spelled = worker_encoder(vocabulary, PrefixEncoder), _spellings(vocabulary)
        for b in batches:
            for start, lists in _encoded(encoder, b.column(1)):
                for at, part, decoded in _decoded(lists, spelled):
                    yield pa.RecordBatch.from_arrays([b.column(0).slice(start + at, len(part)), part, decoded], names=["id", "ids", "decoded"])

    return rows.mapInArrow(run, schema + ", decoded string")
