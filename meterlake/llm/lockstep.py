"""Token paths of many words at once.

Where a word has one path of tokens, each of its prefixes that tokens make up has one last
token: the one that a token path ends with. ``Paths`` reads words as bytes. A trie, kept as
a transition table, gives the tokens that match at every byte, one step of the trie for all
bytes of all words; then prefixes are taken by their length, that of all words at once: the
token that ends a prefix is the one match that may follow the last token of the prefix
before it. Which token may follow which is asked of ``follows``, a tokenizer's own rule; the
answers are kept in a table of bounded size. Ids are read backwards from the last tokens.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

_MIX = np.uint64(0x9E3779B97F4A7C15)

# Symbols a step of the work takes, and the length of a word that it takes in lockstep.
STEP_SYMBOLS = 1 << 16
LOCKSTEP = 160
# Answers of ``follows`` a worker keeps.
KEPT_ANSWERS = 1 << 18


class Lookup:
    """A table of whole numbers by whole numbers from 0 on, put in and asked for in arrays."""

    def __init__(self, room: int):
        self.bits = max(4, (2 * room - 1).bit_length())
        self.clear()

    def clear(self) -> None:
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.zeros(1 << self.bits, np.int32)
        self.count = 0

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * _MIX) >> np.uint64(64 - self.bits)).view(np.int64)

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """``keys`` are distinct and new."""
        self.count += len(keys)
        at = self._slots(keys)
        while len(keys):
            free = self.keys[at] < 0
            self.keys[at[free]] = keys[free]  # of several for one slot, one gets it
            placed = self.keys[at] == keys
            self.values[at[placed]] = values[placed]
            keys, values = keys[~placed], values[~placed]
            at = (at[~placed] + 1) & ((1 << self.bits) - 1)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The values, -1 where a key is missing."""
        at = self._slots(keys)
        held = self.keys[at]
        out = np.where(held == keys, self.values[at], np.int32(-1))
        rest = np.flatnonzero((held != keys) & (held >= 0))
        while len(rest):
            at[rest] = (at[rest] + 1) & ((1 << self.bits) - 1)
            held = self.keys[at[rest]]
            hit = held == keys[rest]
            out[rest[hit]] = self.values[at[rest[hit]]]
            rest = rest[~hit & (held >= 0)]
        return out


def gathered(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The runs ``starts, counts`` of ``flat`` that ``which`` names, one after the other."""
    n = counts[which]
    before = np.cumsum(n) - n
    return flat[np.arange(int(n.sum())) + np.repeat(starts[which] - before, n)]


def starts_of(counts: np.ndarray) -> np.ndarray:
    return np.cumsum(counts) - counts


def spines(child: list[int]) -> np.ndarray:
    """For each token the tokens from its outermost part up to itself, by the part that
    ``child`` names (-1: none); rows end in -1."""
    chains = []
    for token in range(len(child)):
        chain = [token]
        while child[chain[-1]] >= 0:
            chain.append(child[chain[-1]])
        chains.append(chain[::-1])
    found = np.full((len(child), max(map(len, chains), default=0) + 1), -1, np.int32)
    for token, chain in enumerate(chains):
        found[token, : len(chain)] = chain
    return found


class Paths:
    """The token paths of words. ``tokens`` gives the bytes of each token that may occur;
    ``follows(last, token)`` takes arrays and says which tokens may follow which, and
    ``follows_one`` the same for one pair. Every token may come first."""

    def __init__(
        self,
        tokens: dict[int, bytes],
        follows: Callable[[np.ndarray, np.ndarray], np.ndarray],
        follows_one: Callable[[int, int], bool],
    ):
        self.follows, self.follows_one = follows, follows_one
        self.sizes = np.zeros(max(tokens) + 1, np.int32)
        children: dict[int, int] = {}
        ends: dict[int, int] = {}
        for token, label in tokens.items():
            node = 0
            for symbol in label:
                key = node << 8 | symbol
                node = children.setdefault(key, len(children) + 1)
            ends[node] = token
            self.sizes[token] = len(label)
        self.trie = Lookup(len(children))
        self.trie.put(np.fromiter(children, np.int64), np.fromiter(children.values(), np.int32))
        self.token_of = np.full(len(children) + 1, -1, np.int32)
        self.token_of[list(ends)] = list(ends.values())
        self.forget()

    def __getstate__(self) -> dict:
        return {k: v for k, v in vars(self).items() if k not in ("answers", "single")}

    def __setstate__(self, state: dict) -> None:
        vars(self).update(state)
        self.forget()

    def forget(self) -> None:
        """Drop the answers that were kept: a task's worker goes on with other work."""
        self.answers = Lookup(KEPT_ANSWERS)
        self.single = {}

    def may_follow(self, last: np.ndarray, token: np.ndarray) -> np.ndarray:
        keys = last.astype(np.int64) << 20 | token
        found = self.answers.get(keys)
        missing = np.flatnonzero(found < 0)
        if len(missing):
            new, where = np.unique(keys[missing], return_inverse=True)
            told = self.follows(new >> 20, new & 0xFFFFF).astype(np.int32)
            found[missing] = told[where]
            if self.answers.count + len(new) > KEPT_ANSWERS:
                self.answers.clear()
            if len(new) <= KEPT_ANSWERS:
                self.answers.put(new, told)
        return found > 0

    def _may_follow_one(self, last: int, token: int) -> bool:
        key = last << 20 | token
        found = self.single.get(key)
        if found is None:
            if len(self.single) >= KEPT_ANSWERS // 4:
                self.single.clear()
            found = self.single[key] = bool(self.follows_one(last, token))
        return found

    def _matches(self, symbols: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
        """Start, end and token of each match; a match from ``i`` ends by ``ends[i]``."""
        at = np.flatnonzero(np.arange(len(symbols)) < ends)
        node = np.zeros(len(at), np.int64)
        starts, tokens, lengths = [], [], []
        length = 0
        while len(at):
            node = self.trie.get(node << 8 | symbols[at + length])
            length += 1
            there = np.flatnonzero(node >= 0)
            at, node = at[there], node[there].astype(np.int64)
            token = self.token_of[node]
            has = np.flatnonzero(token >= 0)
            starts.append(at[has])
            tokens.append(token[has])
            lengths.append(np.full(len(has), length))
            further = np.flatnonzero(at + length < ends[at])
            at, node = at[further], node[further]
        if not starts:
            return (np.zeros(0, np.int64),) * 3
        start = np.concatenate(starts)
        return start, start + np.concatenate(lengths), np.concatenate(tokens)

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all ``words``, one word after the other, and how many each has.
        Raises ``ValueError`` for a word that no tokens make up."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(lengths, kind="stable")
        ids: list[np.ndarray] = []
        counts = np.zeros(len(words), np.int64)
        at = 0
        while at < len(order):
            # Words of like length, of so many symbols in all.
            room = np.cumsum(lengths[order[at : at + STEP_SYMBOLS]] + 1)
            upto = at + max(1, int(np.searchsorted(room, STEP_SYMBOLS, "right")))
            part = order[at:upto]
            found, n = self._encode_part([words[k] for k in part.tolist()], lengths[part])
            ids.append(found)
            counts[part] = n
            at = upto
        if not ids:
            return np.zeros(0, np.int32), counts
        flat = np.concatenate(ids)
        begin = np.zeros(len(words), np.int64)
        begin[order] = starts_of(counts[order])
        return gathered(flat, begin, counts, np.arange(len(words))), counts

    def _encode_part(self, words: list[bytes], lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # Words are parted by a byte that no UTF-8 text has.
        symbols = np.frombuffer(b"\xfe".join(words) + b"\xfe", np.uint8).astype(np.int64)
        begin = starts_of(lengths + 1)
        ends = np.repeat(begin + lengths, lengths + 1)
        start, end, token = self._matches(symbols, ends)
        # The last token of each prefix (-1: empty, -2: none), and the tokens it has.
        last = np.full(len(symbols), -2, np.int32)
        count = np.zeros(len(symbols), np.int32)
        last[begin] = -1
        if len(words) and int(lengths.max()) > LOCKSTEP:
            self._one_by_one(last, count, start, end, token)
        else:
            length = end - np.repeat(begin, lengths + 1)[start]
            by = np.argsort(length.astype(np.uint8), kind="stable")
            cuts = np.searchsorted(length[by], np.arange(1, LOCKSTEP + 2))
            start, end, token = start[by], end[by], token[by]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                s, e, t = start[a:b], end[a:b], token[a:b]
                before = last[s]
                known = np.flatnonzero(before > -2)
                s, e, t, before = s[known], e[known], t[known], before[known]
                right = before < 0
                inner = np.flatnonzero(~right)
                right[inner] = self.may_follow(before[inner], t[inner])
                s, e, t = s[right], e[right], t[right]
                last[e] = t
                count[e] = count[s] + 1
        place = begin + lengths
        if (last[place] == -2).any():
            raise ValueError("a word that no tokens make up")
        counts = count[place].astype(np.int64)
        out = np.zeros(int(counts.sum()), np.int32)
        base = starts_of(counts) - 1
        live = np.flatnonzero(place > begin)
        while len(live):
            p = place[live]
            t = last[p]
            out[base[live] + count[p]] = t
            place[live] = p - self.sizes[t]
            live = live[place[live] > begin[live]]
        return out, counts

    def _one_by_one(
        self, last: np.ndarray, count: np.ndarray, start: np.ndarray, end: np.ndarray, token: np.ndarray
    ) -> None:
        """The same for long words, a match at a time."""
        by = np.argsort(end, kind="stable")
        ends, counts = last.tolist(), count.tolist()
        follows = self._may_follow_one
        for s, e, t in zip(start[by].tolist(), end[by].tolist(), token[by].tolist(), strict=True):
            before = ends[s]
            if before > -2 and ends[e] < 0 and (before < 0 or follows(before, t)):
                ends[e], counts[e] = t, counts[s] + 1
        last[:], count[:] = ends, counts
