"""Token ids of whole texts through a public tokenizer file.

No token of these files spans U+0020 from its left side (a space only ever opens the next token), so
texts are cut at single spaces, distinct chunks into pieces by the file's own split pattern, and the
library encodes each distinct piece of a batch once; Arrow and numpy do the cutting, the coding and the
gathering. Chunks beyond Latin letters go to the library uncut, and texts with runs of blanks do so
whole where the file keeps blanks. Nothing outlives the batch.
"""

from __future__ import annotations

import json
import sys
import types
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = "Ġ"  # U+0020 in byte letters


def byte_letters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: printable Latin-1 bytes are
    themselves, the others follow from U+0100 on in order."""
    own = {b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF}
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


LETTERS = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f"
WORD_AND_MARKS = f"^(?P<word>[{LETTERS}]+)(?P<marks>[.,;:!?]*)$"


def runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The indices starts[0], starts[0] + 1, ... of consecutive runs."""
    ends = np.cumsum(sizes, dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if total < 1 << 31 else np.int64
    out = np.repeat((starts - (ends - sizes)).astype(kind), sizes)
    out += np.arange(total, dtype=kind)
    return out


class ChunkEncoder:
    """``encode(strings) -> (ids, offsets)``: the ids of all texts and where each text's ids begin."""

    def __init__(self, path: str):
        import public_tokenizers
        import regex
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model
        self.dtype = np.dtype("<u2" if self.library.get_vocab_size(with_added_tokens=True) <= 65536 else "<u4")
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.lower = spec["normalizer"] is not None  # and then blanks are dropped
        split = next((p["pattern"]["Regex"] for p in spec["pre_tokenizer"].get("pretokenizers", []) if p["type"] == "Split"), None)
        self.pieces_of = regex.compile(split or public_tokenizers.PATTERN).findall
        self.plain = regex.compile(r"[\x00-\x1b\x20-\x84\x86-ɏ]*").fullmatch
        self.specials = [t["content"] for t in spec["added_tokens"]]
        if not all("<|" in t for t in self.specials):
            raise ValueError("special tokens are told by <| here")
        letters = byte_letters()
        self.letters = {c: "".join(letters[b] for b in chr(c).encode()) for c in range(0x250)}
    def _library(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, self.dtype).tobytes() for x in found]

    def _spell(self, piece: str) -> str:
        """The piece in byte letters."""
        if piece.isascii() and piece.isprintable():
            return piece.replace(" ", SPACE) if " " in piece else piece
        return piece.translate(self.letters)

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of (lowered) pieces of the split pattern."""
        tokenize, spell, code = self.model.tokenize, self._spell, self.dtype.char
        return [array(code, [t.id for t in tokenize(spell(p))]).tobytes() for p in pieces]

    def _split(self, chunk: str) -> list[str] | None:
        """Pieces of a chunk of Latin letters and common signs; None for others."""
        low = chunk.lower() if self.lower else chunk
        return self.pieces_of(low) if self.plain(low) and "<|" not in low else None

    def _tables(self, chunks: pa.StringArray, spaced: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, sizes) of distinct chunks; where ``spaced``, a space precedes the chunk."""
        found = pc.extract_regex(chunks, WORD_AND_MARKS)
        simple = found.is_valid().to_numpy(zero_copy_only=False)
        word = found.field("word").filter(pa.array(simple))
        marks = found.field("marks").filter(pa.array(simple))
        if self.lower:
            word = pc.utf8_lower(word)
        else:
            word = pc.binary_join_element_wise(pc.if_else(pa.array(spaced[simple]), " ", ""), word, "")
        odd = np.flatnonzero(~simple)
        cut = [self._split(" " + c if sp and not self.lower else c)
               for c, sp in zip(chunks.take(pa.array(odd)).to_pylist(), spaced[odd].tolist(), strict=True)]
        raw = np.array([ps is None for ps in cut], bool)
        marked = pc.binary_length(marks).to_numpy() > 0
        rest = [p for ps in cut if ps is not None for p in ps]
        coded = pa.concat_arrays([word, marks.filter(pa.array(marked)), pa.array(rest, pa.string())]).dictionary_encode()
        code = coded.indices.to_numpy()
        ids = self._pieces(coded.dictionary.to_pylist())
        n_pieces = len(ids)
        ids += self._library([(" " if spaced[k] and not self.lower else "") + chunks[int(k)].as_py() for k in odd[raw]])
        piece_size = np.fromiter(map(len, ids), np.int64, len(ids)) // self.dtype.itemsize
        piece_start = np.cumsum(piece_size) - piece_size
        store = np.frombuffer(b"".join(ids), self.dtype)
        # the pieces of every chunk, in order
        count = np.zeros(len(chunks), np.int64)
        count[simple] = 1 + marked
        count[odd] = [1 if ps is None else len(ps) for ps in cut]
        at = np.cumsum(count) - count
        piece = np.zeros(int(count.sum()), np.int64)
        whole = at[simple]
        piece[whole] = code[: len(word)]
        piece[whole[marked] + 1] = code[len(word): len(word) + int(marked.sum())]
        piece[runs(at[odd[~raw]], count[odd[~raw]])] = code[len(code) - len(rest):]
        piece[at[odd[raw]]] = n_pieces + np.arange(int(raw.sum()))
        size = np.diff(np.concatenate(([0], np.cumsum(piece_size[piece])))[np.concatenate(([0], np.cumsum(count)))])
        return store[runs(piece_start[piece], piece_size[piece])], size

    def encode(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of non-null texts. Call it with some megabytes at a time (``in_slices``)."""
        if not len(texts):
            return np.empty(0, self.dtype), np.zeros(1, np.int64)
        parts = pc.split_pattern(texts, " ")
        bounds = parts.offsets.to_numpy()
        coded = parts.flatten().dictionary_encode()
        bounds = bounds - bounds[0]
        chunk, chunks = coded.indices.to_numpy(), coded.dictionary
        spaced = np.ones(len(chunks), bool)
        blank = np.zeros(len(chunks), bool)
        if not self.lower:  # a text's first chunk has no space before it
            opening = chunks.take(coded.indices.take(pa.array(bounds[:-1]))).dictionary_encode()
            chunk = chunk.copy()
            chunk[bounds[:-1]] = len(chunks) + opening.indices.to_numpy()
            # a chunk that is empty or opens with a blank is part of a run of blanks
            trimmed = pc.utf8_ltrim_whitespace(chunks)
            short = (pc.binary_length(trimmed).to_numpy() < pc.binary_length(chunks).to_numpy()) | (pc.binary_length(chunks).to_numpy() == 0)
            blank = np.concatenate((short, np.zeros(len(opening.dictionary), bool)))
            spaced = np.concatenate((spaced, np.zeros(len(opening.dictionary), bool)))
            chunks = pa.concat_arrays([chunks, opening.dictionary])
        store, size = self._tables(chunks, spaced)
        begin = np.cumsum(size) - size
        n = size[chunk]
        ids = store[runs(begin[chunk], n)]
        offsets = np.concatenate(([0], np.cumsum(n)))[bounds]
        if blank.any():
            whole = np.flatnonzero(np.diff(np.concatenate(([0], np.cumsum(blank[chunk])))[bounds]))
            if len(whole):
                each = np.split(ids, offsets[1:-1])
                for k, x in zip(whole, self._library([texts[int(k)].as_py() for k in whole]), strict=True):
                    each[k] = np.frombuffer(x, self.dtype)
                ids = np.concatenate(each)
                offsets = np.concatenate(([0], np.cumsum([len(x) for x in each])))
        return ids, offsets


def worker_encoder(path: str, kind: type = ChunkEncoder):
    """The encoder of this Python worker, made once per process."""
    held = sys.modules.setdefault("_chunk_encoders", types.ModuleType("_chunk_encoders")).__dict__
    key = f"{kind.__name__}:{path}"
    if key not in held:
        held[key] = kind(path)
    return held[key]


SLICE_BYTES = 8 << 20


def in_slices(texts: pa.StringArray, limit: int = SLICE_BYTES):
    """(start, part) of consecutive parts of about ``limit`` bytes, so that one part's chunks stay in bounds.

    The more texts share a part, the fewer distinct pieces there are to encode for each of them.
    """
    size = np.concatenate(([0], np.cumsum(pc.binary_length(texts).to_numpy().astype(np.int64))))
    at = 0
    while at < len(texts):
        stop = max(at + 1, int(np.searchsorted(size, size[at] + limit, side="right")) - 1)
        yield at, texts.slice(at, stop - at)
        at = stop


def with_end(ids: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The end id after every text."""
    return np.insert(ids, offsets[1:], end_id), offsets + np.arange(len(offsets))
