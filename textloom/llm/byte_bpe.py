"""Byte-level BPE read from a tokenizer file, encoded by last-token states.

The BPE encoding of a byte string is determined by its last token: for every prefix there is exactly one token t that
ends there and may follow the last token of the prefix before t, where `a` may be followed by `b` if the merges turn
the bytes of both into exactly [a, b]. So a prefix's state is one token, the state of a longer prefix follows from
those before it, and words that share a prefix share its states.
"""

from __future__ import annotations

import json
from functools import lru_cache

import ahocorasick
import regex


#: Pairs of tokens of which a worker keeps whether one may follow the other.
MEMO_PAIRS = 2_000_000


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for the 256 bytes in a vocabulary file: printable ones for themselves, the others
    from 256 on, in order."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


class ByteBpe:
    """`data`: the content of a tokenizers .json file with a byte-level BPE model."""

    def __init__(self, data: bytes):
        spec = json.loads(data)
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix"))
        if model["type"] != "BPE" or not plain or model.get("ignore_merges") or spec.get("normalizer") or (
                pre.get("type"), pre.get("add_prefix_space"), pre.get("use_regex")) != ("ByteLevel", False, True):
            raise ValueError("only plain byte-level BPE files are supported")
        byte_of = byte_alphabet()
        as_bytes = lambda piece: bytes(byte_of[c] for c in piece)
        self.ids = {as_bytes(piece): i for piece, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = max([*model["vocab"].values(), *self.special.values()]) + 1
        self.bytes_of: list[bytes] = [b""] * size
        for piece, i in self.ids.items():
            self.bytes_of[i] = piece
        for text, i in self.special.items():
            self.bytes_of[i] = text.encode()
        self.merges = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            left, right = as_bytes(a), as_bytes(b)
            self.merges[self.ids[left], self.ids[right]] = rank, self.ids[left + right]
        self.size = size
        # every way a token can end -> the token that is all of it, or none
        self.tails: dict[bytes, int | None] = {piece[i:]: None for piece in self.ids for i in range(len(piece))}
        self.tails.update(self.ids)
        # the merge that makes a token, where each has one and its parts are made before: then merges go by rank
        self.made = {token: (rank, *pair) for pair, (rank, token) in self.merges.items()}
        self.by_rank = len(self.made) == len(self.merges) and all(
            self.made.get(part, (-1,))[0] < rank for rank, *parts in self.made.values() for part in parts)
        self._edges: tuple[dict, dict] = {}, {}
        self.endings = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            self.endings.add_word(piece.decode("latin-1"), (i, len(piece)))
        self.endings.make_automaton()
        if not all(bytes([b]) in self.ids for b in range(256)):
            raise ValueError("the vocabulary lacks a byte")
        self._follows: dict[int, bool] = {}
        self._alone: dict[int, bool] = {}
        names = sorted(self.special, key=len, reverse=True)
        self._special = regex.compile("|".join(map(regex.escape, names))) if names else None

    def merge(self, word: bytes) -> list[int]:
        """The merges by rank, as defined. Only used to find which tokens stand alone or may follow each other."""
        out = [self.ids[word[i:i + 1]] for i in range(len(word))]
        while len(out) > 1:
            found = [(m[0], i, m[1]) for i in range(len(out) - 1) if (m := self.merges.get((out[i], out[i + 1])))]
            if not found:
                break
            _, i, merged = min(found)
            out[i:i + 2] = [merged]
        return out

    def alone(self, token: int) -> bool:
        ok = self._alone.get(token)
        if ok is None:
            ok = self._alone[token] = self.merge(self.bytes_of[token]) == [token]
        return ok

    def _edge(self, token: int, right: int) -> list[tuple[int, float]]:
        """What stands at the left (0) or right (1) edge of a token while it is put together, each with the rank of the
        merge that ends it: the token itself, its part at that edge, and so on to a byte."""
        out = self._edges[right].get(token)
        if out is None:
            out, part, until = [], token, float("inf")
            while True:
                out.append((part, until))
                if part not in self.made:
                    break
                until, part = self.made[part][0], self.made[part][1 + right]
            self._edges[right][token] = out
        return out

    def _joined(self, a: int, b: int) -> bool:
        """Whether some merge takes a piece on both sides of the border: both must still stand at its rank. At the same
        rank the pair further left goes first, so one within `a` comes before it and one within `b` after it."""
        merges, left = self.merges, self._edge(b, 0)
        for x, x_until in self._edge(a, 1):
            for y, y_until in left:
                found = merges.get((x, y))
                if found is not None and found[0] < x_until and found[0] <= y_until:
                    return True
        return False

    def follows(self, a: int, b: int) -> bool:
        ok = self._follows.get(a * self.size + b)
        if ok is None:
            if self.by_rank:
                ok = self.alone(a) and self.alone(b) and not self._joined(a, b)
            else:
                ok = self.merge(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
            if len(self._follows) >= MEMO_PAIRS:
                self._follows.clear()
            self._follows[a * self.size + b] = ok
        return ok

    def extend(self, word: bytes, known: int, last: list[int], start: list[int]) -> None:
        """States of the prefixes longer than `known` bytes: `last[i]` ends the encoding of word[:i] and begins at
        `start[i]`. Both lists hold what is known, from index 0 to `known`, and are cut or extended in place. Tokens that
        end at a byte are tried from the shortest on, as far as some token ends so; only one of them fits."""
        del last[known + 1:], start[known + 1:]
        tails, follows, size = self.tails, self._follows, self.size
        for end in range(known + 1, len(word) + 1):
            for begin in range(end - 1, -1, -1):
                token = tails[word[begin:end]]
                if token is None:
                    continue
                if begin:
                    ok = follows.get(last[begin] * size + token)
                    if ok is None:
                        ok = self.follows(last[begin], token)
                else:
                    ok = self.alone(token)
                if ok:
                    last.append(token)
                    start.append(begin)
                    break

    def states(self, word: bytes) -> tuple[list[int], list[int]]:
        """`extend` for one word from its start; the automaton lists the tokens that end at each byte, longest first."""
        last, start, done = [-1], [0], -1
        follows, size = self._follows, self.size
        for end, (token, length) in self.endings.iter(word.decode("latin-1")):
            if end == done:
                continue
            begin = end + 1 - length
            if begin:
                ok = follows.get(last[begin] * size + token)
                if ok is None:
                    ok = self.follows(last[begin], token)
            else:
                ok = self.alone(token)
            if ok:
                last.append(token)
                start.append(begin)
                done = end
        return last, start

    def segments(self, text: str) -> list[tuple[bool, str]]:
        """(is special, piece of text)."""
        if not self._special or not any(s in text for s in self.special):
            return [(False, text)] if text else []
        out, at = [], 0
        for m in self._special.finditer(text):
            if m.start() > at:
                out.append((False, text[at:m.start()]))
            out.append((True, m.group()))
            at = m.end()
        return out + [(False, text[at:])] if at < len(text) else out


@lru_cache(maxsize=4)
def load(data: bytes) -> ByteBpe:
    """One per worker process and file: what is learned about pairs serves all its tasks."""
    return ByteBpe(data)
