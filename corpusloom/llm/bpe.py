"""Byte-level byte-pair encoding from a public vocabulary, over arrays of pieces.

``Merges`` holds a vocabulary as arrays. ``merge_rounds`` is the exact algorithm as
repeated joins of adjacent symbol pairs with the table of merge ranks; ``Encoder``
speculates with greedy longest matches and verifies them pair by pair.
"""

from __future__ import annotations

import json
import os

import numpy as np
import regex

TOKENIZER_DIR = "/opt/tokenizers"
# Unicode white space, and the split pattern of the vocabulary with that class spelled out.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
_NEVER = np.int64(1) << 40


def _byte_letters() -> dict[str, int]:
    """The vocabulary file's letter of each byte: printable Latin-1 as itself, the others from U+0100 on."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Merges:
    """A byte-level vocabulary: ids of bytes, and of every pair that merges, by rank."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        letters, vocab = _byte_letters(), model["vocab"]
        size = max(vocab.values()) + 2
        self.byte_ids = np.zeros(256, np.int64)
        for letter, byte in letters.items():
            self.byte_ids[byte] = vocab[letter]
        self.left, self.right = np.full(size, -1, np.int64), np.full(size, -1, np.int64)
        self.birth = np.full(size, -1, np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        a = np.array([vocab[x] for x, _ in pairs])
        b = np.array([vocab[y] for _, y in pairs])
        made = np.array([vocab[x + y] for x, y in pairs])
        rank = np.arange(len(pairs))
        self.left[made[::-1]], self.right[made[::-1]], self.birth[made[::-1]] = a[::-1], b[::-1], rank[::-1]  # the first rank wins
        key = (a << 32) | b
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks, self.made = key[order], rank[order], made[order]
        self.spelled = {vocab[t]: bytes(letters[c] for c in t) for t in [*letters, *(x + y for x, y in pairs)]}
        ids, bounds = self.merge_rounds(list(self.spelled.values()))
        alone = np.diff(bounds) == 1
        self.canonical = {t for t, ok, i in zip(self.spelled, alone, ids[bounds[:-1]]) if ok and i == t}

    def joined(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and id of the merges of adjacent symbols; the rank is ``_NEVER`` where there is none."""
        key = (x << 32) | y
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        return np.where(hit, self.ranks[at], _NEVER), np.where(hit, self.made[at], -1)

    def merge_rounds(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and boundaries of the pieces, by lowest-rank merges until none applies.

        Each round joins all adjacent pairs with the ranks, takes each piece's lowest, and
        applies it from the left. Pieces where nothing joins leave the rounds.
        """
        lengths = np.array([len(p) for p in pieces], np.int64)
        if not lengths.sum():
            return np.zeros(0, np.int64), np.zeros(len(pieces) + 1, np.int64)
        sym = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        piece = np.repeat(np.arange(len(pieces)), lengths)
        order = np.arange(len(sym))
        done_sym, done_piece, done_order = [], [], []
        while len(sym):
            rank = np.full(len(sym), _NEVER)
            new = np.full(len(sym), -1)
            if len(sym) > 1:
                rank[:-1], new[:-1] = self.joined(sym[:-1], sym[1:])
                rank[:-1][piece[:-1] != piece[1:]] = _NEVER
            first = np.flatnonzero(np.concatenate([[True], piece[1:] != piece[:-1]]))
            best = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.concatenate([first, [len(sym)]])))
            live = best < _NEVER
            if not live.all():
                done_sym.append(sym[~live]), done_piece.append(piece[~live]), done_order.append(order[~live])
                sym, piece, order, rank, new, best = (v[live] for v in (sym, piece, order, rank, new, best))
                if not len(sym):
                    break
            hit = rank == best
            # in a run of hits (as in "aaaa") only every other one can be applied
            at = np.flatnonzero(hit)
            fresh = np.concatenate([[True], np.diff(at) > 1])
            start = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - start) % 2 == 0]
            sym = sym.copy()
            sym[at] = new[at]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            sym, piece, order = sym[keep], piece[keep], order[keep]
        sym, piece, order = (np.concatenate(v) for v in (done_sym, done_piece, done_order))
        place = np.argsort(order, kind="stable")
        bounds = np.zeros(len(pieces) + 1, np.int64)
        np.cumsum(np.bincount(piece, minlength=len(pieces)), out=bounds[1:])
        return sym[place], bounds

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether tokens ``a`` and ``b`` can stand side by side in an encoding.

        Goes back in time from the finished tokens: the one formed last is taken apart, so
        the ends that met at the seam appear in turn. The two are incompatible if ends that
        met would have merged before one of them was used up inside its own token.
        """
        ok = np.ones(len(a), bool)
        live = np.arange(len(a))
        x, y = a.copy(), b.copy()
        until_x, until_y = np.full(len(a), _NEVER), np.full(len(a), _NEVER)
        while len(live):
            rank, _ = self.joined(x, y)
            bad = (rank < until_x) & (rank <= until_y) & (rank < _NEVER)
            ok[live[bad]] = False
            on = ~bad & ((self.birth[x] >= 0) | (self.birth[y] >= 0))
            live, x, y, until_x, until_y = live[on], x[on], y[on], until_x[on], until_y[on]
            split_x = self.birth[x] > self.birth[y]
            until_x = np.where(split_x, self.birth[x], until_x)
            until_y = np.where(split_x, until_y, self.birth[y])
            x, y = np.where(split_x, self.right[x], x), np.where(split_x, y, self.left[y])
        return ok


def merges_path(tokenizer_dir: str = TOKENIZER_DIR, name: str = "byte_bpe_50k.json") -> str:
    return os.path.join(tokenizer_dir, name)


class Encoder:
    """Speculate and verify: ids of pieces, memoised per worker process."""

    def __init__(self, merges: Merges):
        self.m = merges
        self.split = regex.compile(PATTERN).findall
        self.step: dict[int, int] = {}
        self.token: list[int] = [-1]
        for token in merges.canonical:
            node = 0
            for byte in merges.spelled[token]:
                key = node << 8 | byte
                if (node := self.step.get(key, -1)) < 0:
                    node = self.step[key] = len(self.token)
                    self.token.append(-1)
            self.token[node] = token
        self.exact = 0  # pieces that needed exact merging, for tests and reports

    def propose(self, piece: bytes) -> list[int]:
        """Greedy longest matches from the left."""
        step, token, out, at, n = self.step.get, self.token, [], 0, len(piece)
        while at < n:
            node, look, best, end = 0, at, -1, at
            while look < n and (node := step(node << 8 | piece[look], -1)) >= 0:
                look += 1
                if token[node] >= 0:
                    best, end = token[node], look
            out.append(best)
            at = end
        return out

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and boundaries of non-empty pieces."""
        proposed = [self.propose(p) for p in pieces]
        bounds = np.zeros(len(pieces) + 1, np.int64)
        np.cumsum([len(p) for p in proposed], out=bounds[1:])
        flat = np.fromiter((i for p in proposed for i in p), np.int64, bounds[-1])
        if len(flat) < 2:
            return flat, bounds
        owner = np.repeat(np.arange(len(pieces)), np.diff(bounds))
        seam = np.flatnonzero(owner[:-1] == owner[1:])
        pairs, where = np.unique((flat[seam] << 32) | flat[seam + 1], return_inverse=True)
        ok = self.m.compatible(pairs >> 32, pairs & 0xFFFFFFFF)[where]
        failed = np.unique(owner[seam[~ok]])
        if not len(failed):
            return flat, bounds
        self.exact += len(failed)
        fixed, edges = self.m.merge_rounds([pieces[i] for i in failed])
        parts = [flat[bounds[i] : bounds[i + 1]] for i in range(len(pieces))]
        for k, i in enumerate(failed):
            parts[i] = fixed[edges[k] : edges[k + 1]]
        np.cumsum([len(p) for p in parts], out=bounds[1:])
        return np.concatenate(parts), bounds
