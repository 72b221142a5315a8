"""Token ids of whole texts by a public ``tokenizers`` file, encoded piece-wise.

The byte-level pre-tokenizer never joins characters across a single space or
line end that stands between two other characters, so a text whose white space
is all of that kind may be cut before each space and the pieces encoded on
their own; any other text goes to the library whole. A worker keeps the ids of the pieces
it has met (bounded), and a batch's new pieces go to the library in one call.
Strings of special tokens inside a text are ordinary text.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import hold

CACHE_PIECES = 500_000      # that a worker remembers; more are encoded anew in each batch
CHUNK_CHARS = 4_000_000     # characters of a batch that are encoded together
JOINED = 20_000             # plain pieces in one call of the library

#: White space other than the space and the line end, and spaces side by side.
_NOT_SIMPLE = (r"[\t\r\x0b\x0c\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
               r"|[ \n][ \n]")
#: Letters of a fixed block; a mark after them is always a token of its own.
_MARKED = r"^[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{24f}]+[,.;:!?]\z"
_MARKS = ",.;:!?"


def simple(texts: pa.Array) -> np.ndarray:
    """Where every white space is a space or line end that stands alone."""
    return ~pc.match_substring_regex(texts, _NOT_SIMPLE).to_numpy(zero_copy_only=False).astype(bool)


def _where(mask: pa.Array) -> list[int]:
    return np.flatnonzero(mask.to_numpy(zero_copy_only=False)).tolist()


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenated runs ``flat[starts[k]:starts[k] + lengths[k]]``."""
    before = np.cumsum(lengths) - lengths
    return flat[np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class PieceEncoder:
    """Little-endian unsigned 32-bit ids, as bytes, of texts."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.by_piece: dict[str, bytes] = {}     # after a space
        self.by_line: dict[str, bytes] = {}      # after a line end
        self.line, self.space, *marks = self._encode(["\n", " ", *_MARKS])
        self.line_end = int.from_bytes(self.line, "little")
        self.mark = dict(zip(_MARKS, marks))

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _plain(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces without white space, each after a space. They go to the
        library as the lines of one text: a lone line end is a token of its own."""
        out: list[bytes] = []
        end = self.line_end
        for at in range(0, len(pieces), JOINED):
            part = pieces[at:at + JOINED]
            found = self.tokenizer.encode_batch_fast([" " + "\n ".join(part)], add_special_tokens=False)
            ids = np.array(found[0].ids, "<u4")
            cuts = np.flatnonzero(ids == end)
            raw, a = ids.tobytes(), 0
            for b in (cuts * 4).tolist():
                out.append(raw[a:b])
                a = b + 4
            out.append(raw[a:])
        return out

    def ids_of(self, column: pa.Array) -> list[bytes]:
        """Ids of different pieces, each after a space. A line end between other
        characters and a mark after letters part a piece further."""
        known, starts = self.by_piece, self.by_line
        pieces = column.to_numpy(zero_copy_only=False).tolist()
        out = list(map(known.get, pieces))
        lined = [(k, pieces[k].split("\n")) for k in _where(pc.match_substring(column, "\n")) if out[k] is None]
        marked = [k for k in _where(pc.match_substring_regex(column, _MARKED)) if out[k] is None]
        for k in marked:
            out[k] = b"."
        for k, _ in lined:
            out[k] = b"."
        plain = [k for k, x in enumerate(out) if x is None]
        # openings of parted pieces are pieces themselves
        heads = {x for x in [*(pieces[k][:-1] for k in marked), *(v[0] for _, v in lined)] if x not in known}
        fresh = [pieces[k] for k in plain]
        heads.difference_update(fresh, [""])
        found = dict(zip(fresh := fresh + list(heads), self._plain(fresh)))
        opened = [x for x in {y for _, v in lined for y in v[1:]} if x not in starts]
        more = dict(zip(opened, self._encode(opened)))
        for k in plain:
            out[k] = found[pieces[k]]
        for k in marked:
            p = pieces[k]
            out[k] = found[p] = (found.get(p[:-1]) or known[p[:-1]]) + self.mark[p[-1]]
        for k, v in lined:
            head = (found.get(v[0]) or known[v[0]]) if v[0] else b""
            out[k] = head + b"".join([self.line + (more[x] if x in more else starts[x]) for x in v[1:]])
        if "" in found:
            out[pieces.index("")] = self.space      # a space at the end of a text
            del found[""]
        new = len(plain) + len(marked) + len(lined)
        if len(known) > CACHE_PIECES // 2 and 2 * new > len(pieces):
            known.clear()        # the texts have changed: what is known no longer helps
            starts.clear()
        if len(known) + len(found) <= CACHE_PIECES:
            known.update(found)
        if len(starts) + len(more) <= CACHE_PIECES // 4:
            starts.update(more)
        return out

    def _some(self, texts: list[str]) -> list[bytes]:
        column = pa.array(texts, pa.string())
        plain = simple(column)
        at = np.flatnonzero(plain)
        out = [b""] * len(texts)
        if len(at):
            words = pc.split_pattern(column.filter(pa.array(plain)), " ")
            first = words.offsets.to_numpy()[:-1] - words.offsets[0].as_py()
            flat = words.flatten()
            coded = flat.dictionary_encode()
            openers = self._encode(flat.take(pa.array(first)).to_pylist())
            ids = self.ids_of(coded.dictionary) + openers
            which = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            which[first] = len(coded.dictionary) + np.arange(len(first))
            size = np.fromiter(map(len, ids), np.int64, len(ids)) >> 2
            wide = size[which]
            raw = gather(np.frombuffer(b"".join(ids), "<u4"), (np.cumsum(size) - size)[which], wide).tobytes()
            ends = 4 * np.cumsum(np.add.reduceat(wide, first))
            a = 0
            for k, b in zip(at.tolist(), ends.tolist()):
                out[k] = raw[a:b]
                a = b
        others = np.flatnonzero(~plain).tolist()
        for k, found in zip(others, self._encode([texts[k] for k in others])):
            out[k] = found
        return out

    def clear(self) -> None:
        self.by_piece.clear()
        self.by_line.clear()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        out: list[bytes] = []
        chunk: list[str] = []
        size = 0
        for t in texts:
            chunk.append(t or "")
            size += len(chunk[-1])
            if size > CHUNK_CHARS:
                out += self._some(chunk)
                chunk, size = [], 0
        return out + self._some(chunk) if chunk else out


_encoders: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """This worker's encoder for a file."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    hold(_encoders[path])
    return _encoders[path]
