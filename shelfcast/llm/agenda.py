"""Merge-type subword encoding on an agenda of adjacent symbol pairs.

A text starts as its characters. The agenda holds every adjacent pair that a vocabulary
piece spells out, best score first and leftmost among equals; the best pair is merged and
its two new neighbours enter the agenda, until it is empty. Characters outside the
vocabulary become their UTF-8 bytes.

Two adjacent characters that no piece contains side by side can never be merged across, so
a text is cut there and equal segments are encoded once. Short segments of a batch advance
together, one merge each per step; long ones run on a heap.
"""

from __future__ import annotations

import heapq
from itertools import pairwise

import numpy as np

# Segments up to this many characters are encoded together as rows of a matrix.
ROW_WIDTH = 48
NO_PAIR = np.iinfo(np.int32).max
SPACE = "▁"
# Characters that stand outside the Unicode range mark symbols without a piece.
OUTSIDE = 1 << 22


class Agenda:
    """Encoder for the pieces of a loaded processor (normal, unknown, control and byte pieces)."""

    def __init__(self, processor):
        kinds = (processor.is_control, processor.is_unknown, processor.is_byte, processor.is_unused)
        size = processor.vocab_size()
        normal = [i for i in range(size) if not any(kind(i) for kind in kinds)]
        self.pieces = {processor.id_to_piece(i): i for i in normal}
        self.size = size
        scores = {i: processor.get_score(i) for i in normal}
        by_score = {score: at for at, score in enumerate(sorted(set(scores.values()), reverse=True))}
        self.rank = np.full(size, NO_PAIR, np.int32)
        for i, score in scores.items():
            self.rank[i] = by_score[score]
        self.bytes = [processor.piece_to_id(f"<0x{byte:02X}>") for byte in range(256)]
        self._byte_of = {piece: byte for byte, piece in enumerate(self.bytes)}
        # Bytes of one-byte characters spell themselves, alone or in a run.
        self.spelling = {i: processor.id_to_piece(i) for i in normal}
        self.spelling |= {piece: chr(byte) for piece, byte in self._byte_of.items() if byte < 128}
        self._tabulate()

    def _tabulate(self) -> None:
        letters = sorted({c for piece in self.pieces for c in piece})
        # A symbol is a piece, or a character that only longer pieces contain.
        lone = {c: self.size + at for at, c in enumerate(c for c in letters if c not in self.pieces)}
        self.lone = {symbol: c for c, symbol in lone.items()}
        self.symbol_of = self.pieces | lone
        self.code_symbol = np.arange(0x110000, dtype=np.int32) + OUTSIDE
        for c in letters:
            self.code_symbol[ord(c)] = self.symbol_of[c]
        known = self.symbol_of
        pairs = {
            (known[piece[:cut]], known[piece[cut:]]): number
            for piece, number in self.pieces.items()
            for cut in range(1, len(piece))
            if piece[:cut] in known and piece[cut:] in known
        }
        self.pairs = pairs
        left, right = np.array(list(pairs), np.int64).T
        keys = (left << 32) | right
        order = np.argsort(keys)
        self._keys = np.append(keys[order], np.iinfo(np.int64).max)
        self._merged = np.append(np.array(list(pairs.values()), np.int32)[order], 0)
        # Which characters stand side by side in some piece.
        inner = sorted({c for piece in self.pieces if len(piece) > 1 for c in piece})
        self._inner = np.zeros(0x110000, np.int32)
        for at, c in enumerate(inner):
            self._inner[ord(c)] = at + 1
        self._width = len(inner) + 1
        joined = np.zeros((self._width, self._width), bool)
        for piece in self.pieces:
            for a, b in pairwise(piece):
                joined[self._inner[ord(a)], self._inner[ord(b)]] = True
        self._apart = ~joined.ravel()
        # A character that no merge takes in, to stand between segments.
        self.separator = next(c for c in map(chr, range(1, 0x110000)) if not self._inner[ord(c)])

    def segments(self, text: str) -> list[str]:
        """The text, cut wherever no merge can cross."""
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        place = self._inner[codes]
        cuts = np.flatnonzero(self._apart[place[:-1] * self._width + place[1:]]) + 1
        ends = [0, *cuts.tolist(), len(text)]
        return [text[a:b] for a, b in pairwise(ends)]

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merged symbol and its rank for each pair; NO_PAIR where no piece spells it."""
        keys = (left.astype(np.int64) << 32) | right
        at = np.searchsorted(self._keys, keys)
        found = self._keys[at] == keys
        merged = self._merged[at]
        return merged, np.where(found, self.rank[merged], NO_PAIR)

    def encode_all(self, segments: list[str]) -> list[bytes]:
        """Ids of each segment as the bytes of an int32 array."""
        lengths = np.array([len(s) for s in segments], np.int64)
        out: list[bytes] = [b""] * len(segments)
        order = np.argsort(lengths, kind="stable")
        start = 0
        while start < len(order):
            width = int(lengths[order[start]])
            # Rows of about equal width share a matrix.
            limit = min(ROW_WIDTH, max(4, width + width // 4))
            stop = int(np.searchsorted(lengths[order], limit, side="right"))
            if width > ROW_WIDTH:
                out[order[start]] = self._encode_long(segments[order[start]])
                start += 1
                continue
            chosen = order[start:stop]
            for i, ids in zip(chosen, self._encode_rows([segments[i] for i in chosen], limit)):
                out[i] = ids
            start = stop
        return out

    def _encode_rows(self, segments: list[str], width: int) -> list[bytes]:
        rows = len(segments)
        lengths = np.array([len(s) for s in segments])
        codes = np.frombuffer("".join(segments).encode("utf-32-le", "surrogatepass"), np.uint32)
        filled = np.arange(width) < lengths[:, None]
        symbols = np.full((rows, width + 1), -1, np.int64)
        symbols[:, :width][filled] = self.code_symbol[codes]
        after = np.tile(np.arange(1, width + 2), (rows, 1))  # next symbol that is left
        before = after - 2
        agenda = np.full((rows, width + 1), NO_PAIR, np.int32)
        result = np.zeros((rows, width + 1), np.int32)
        both = np.zeros((rows, width + 1), bool)
        both[:, : width - 1] = filled[:, 1:]
        r, c = np.nonzero(both)
        result[r, c], agenda[r, c] = self._look_up(symbols[r, c], symbols[r, c + 1])
        active = np.arange(rows)
        while active.size:
            best = agenda[active].argmin(axis=1)
            go = agenda[active, best] != NO_PAIR
            active, best = active[go], best[go]
            if not active.size:
                break
            gone = after[active, best]
            following = after[active, gone]
            symbols[active, best] = result[active, best]
            symbols[active, gone] = -1
            agenda[active, gone] = NO_PAIR
            after[active, best] = following
            before[active, np.minimum(following, width)] = best
            self._refresh(symbols, agenda, result, active, best, np.minimum(following, width))
            earlier = before[active, best]
            has = earlier >= 0
            self._refresh(symbols, agenda, result, active[has], earlier[has], best[has])
        return self._rows_to_ids(symbols[:, :width], lengths)

    def _refresh(self, symbols, agenda, result, rows, left, right) -> None:
        a, b = symbols[rows, left], symbols[rows, right]
        merged, rank = self._look_up(a, np.maximum(b, 0))
        result[rows, left] = merged
        agenda[rows, left] = np.where(b >= 0, rank, NO_PAIR)

    def _rows_to_ids(self, symbols: np.ndarray, lengths: np.ndarray) -> list[bytes]:
        kept = symbols >= 0
        flat = symbols[kept]
        ends = np.cumsum(kept.sum(axis=1)).tolist()
        plain = flat.astype(np.int32)
        odd = np.zeros(len(flat), bool)
        odd[flat >= self.size] = True
        data = plain.tobytes()
        pieces = [data[4 * a : 4 * b] for a, b in pairwise([0, *ends])]
        if odd.any():
            starts = np.array([0, *ends[:-1]])
            for row in np.unique(np.searchsorted(starts, np.flatnonzero(odd), side="right") - 1):
                pieces[row] = self._ids(flat[starts[row] : ends[row]].tolist())
        return pieces

    def _ids(self, symbols: list[int]) -> bytes:
        ids: list[int] = []
        for symbol in symbols:
            if symbol < self.size:
                ids.append(symbol)
            else:
                c = self.lone.get(symbol) or chr(symbol - OUTSIDE)
                ids.extend(self.bytes[byte] for byte in c.encode("utf-8", "surrogatepass"))
        return np.array(ids, np.int32).tobytes()

    def _encode_long(self, segment: str) -> bytes:
        symbols = [self.symbol_of.get(c, OUTSIDE + ord(c)) for c in segment]
        after, before = list(range(1, len(symbols) + 1)), list(range(-1, len(symbols) - 1))
        agenda: list[tuple[int, int, int, int, int]] = []

        def enter(left: int, right: int) -> None:
            merged = self.pairs.get((symbols[left], symbols[right]))
            if merged is not None:
                rank = int(self.rank[merged])
                heapq.heappush(agenda, (rank, left, right, symbols[left], symbols[right]))

        for left in range(len(symbols) - 1):
            enter(left, left + 1)
        while agenda:
            _, left, right, a, b = heapq.heappop(agenda)
            if symbols[left] != a or symbols[right] != b or after[left] != right:
                continue  # one of the two has been merged since
            symbols[left], symbols[right] = self.pairs[a, b], -1
            after[left] = after[right]
            if after[left] < len(symbols):
                before[after[left]] = left
                enter(left, after[left])
            if before[left] >= 0:
                enter(before[left], left)
        return self._ids([s for s in symbols if s >= 0])

    def decode(self, ids: list[int]) -> str:
        """Spelling of the ids; byte pieces are joined before they are read as UTF-8."""
        try:
            return "".join(map(self.spelling.__getitem__, ids))
        except KeyError:
            pass
        out, run = [], bytearray()
        for i in ids:
            byte = self._byte_of.get(i)
            if byte is not None:
                run.append(byte)
                continue
            if run:
                out.append(run.decode("utf-8", "replace"))
                run.clear()
            out.append(self.spelling.get(i, ""))
        return "".join(out) + run.decode("utf-8", "replace")
