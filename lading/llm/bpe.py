"""Byte-pair encoding by a tokenization automaton, and decoding by its arc labels.

The merges are compiled one after the other into a deterministic automaton over tokens. It begins
with one state that every byte leads back to. The gadget of a merge (u, v) -> w takes the state
that u leads to, makes a copy of it without the arc v, lets u lead to the copy, and gives every
state with an arc u an arc w to where v leads. Arcs with one label thus always share their target,
so a state is named by that label, and a copy differs from its parent by one arc, so all that is
kept of a gadget is which arc was lost and when; rows of the table are worked out from that as
texts need them. A sequence of tokens is the encoding of its bytes if and only if the automaton
has a path for it; of each byte string there is one.

Encoding looks for that path in every pre-split word: the longest token with an arc first, shorter
ones when the rest has no path. Positions without one are marked, so no position is tried twice.

Defined results: a null text counts as empty and has no tokens. Special tokens in a text are found
first, as their own ids. Decoding ids that are no valid UTF-8 gives replacement characters; null
ids count as none; an id outside the vocabulary is an error.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from .words import pieces

MEMO_WORDS = 200_000
MEMO_ARCS = 1_000_000


@dataclass(frozen=True)
class Vocabulary:
    """What a byte-level tokenizer file says."""

    labels: tuple[bytes, ...]
    merges: tuple[tuple[int, int, int], ...]
    specials: tuple[tuple[str, int], ...]


def _byte_characters() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: a byte's own character if it is visible,
    else the next unused one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def load(path: str) -> Vocabulary:
    """Reads a tokenizer file of the byte-level BPE kind. Runs on the driver."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model = spec["model"]
    if spec.get("normalizer") or (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel":
        raise ValueError(f"{path} is not a plain byte-level tokenizer")
    if spec["pre_tokenizer"].get("add_prefix_space") or model.get("ignore_merges"):
        raise ValueError(f"{path} uses options that are not supported")
    of = _byte_characters()
    ids = model["vocab"]
    specials = tuple((t["content"], t["id"]) for t in spec.get("added_tokens") or ())
    labels = [b""] * (max([*ids.values(), *(i for _, i in specials)]) + 1)
    for token, i in ids.items():
        labels[i] = bytes(of[c] for c in token)
    for content, i in specials:
        labels[i] = content.encode()
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    return Vocabulary(
        tuple(labels), tuple((ids[u], ids[v], ids[u + v]) for u, v in pairs), specials)


class Automaton:
    """The compiled merges. A state is named by the label whose arcs all lead to it."""

    def __init__(self, vocabulary: Vocabulary):
        self.size = size = len(vocabulary.labels)
        self.left = [-1] * size
        self.right = [-1] * size
        self.time = [-1] * size
        self.lost: dict[int, int] = {}
        self.arcs: dict[int, bool] = {}
        specials = {i for _, i in vocabulary.specials}
        made = {w for _, _, w in vocabulary.merges}
        alive = [
            len(label) == 1 and i not in specials and i not in made
            for i, label in enumerate(vocabulary.labels)]
        for k, (u, v, w) in enumerate(vocabulary.merges):
            if alive[w]:
                raise ValueError("two merges make the same token")
            # Where u is never followed by v, w never comes about.
            if alive[u] and alive[v] and self._leaves(u, v, k):
                self.left[w], self.right[w], self.time[w] = u, v, k
                self.lost[u * size + v] = k
                alive[w] = True
        self.length = [len(label) for label in vocabulary.labels]
        # Every beginning of a token, with its id or -1, and the next shorter token of each.
        self.nodes: dict[bytes, int] = {}
        for i, label in enumerate(vocabulary.labels):
            if alive[i]:
                self.nodes[label] = i
                for stop in range(1, len(label)):
                    self.nodes.setdefault(label[:stop], -1)
        self.shorter = [-1] * size
        for label, i in self.nodes.items():
            for stop in range(len(label) - 1, 0, -1) if i >= 0 else ():
                if self.nodes[label[:stop]] >= 0:
                    self.shorter[i] = self.nodes[label[:stop]]
                    break

    def _leaves(self, after: int, token: int, before: int) -> bool:
        """Whether ``token`` leaves the state that ``after`` led to ahead of merge ``before``."""
        lost, size, time, right = self.lost, self.size, self.time, self.right
        while True:
            # The copies made for ``after`` so far, and those its right parts brought along.
            state, until = after, before
            while state >= 0:
                when = lost.get(state * size + token)
                if when is not None and when < until:
                    return False
                if time[state] < until:
                    until = time[state]
                state = right[state]
            if time[token] < 0:
                return True
            # An added arc is there if the arc of its left part was when it was added.
            before = min(before, time[token] + 1)
            token = self.left[token]

    def has_arc(self, after: int, token: int) -> bool:
        """Whether ``token`` leaves the final state of ``after``; the answer is kept."""
        if len(self.arcs) >= MEMO_ARCS:
            self.arcs.clear()
        known = self._leaves(after, token, len(self.lost) + self.size)
        self.arcs[after * self.size + token] = known
        return known

    def _longest(self, word: bytes, at: int) -> int:
        """The longest token that begins at ``at``, whether it has an arc or not."""
        nodes, token = self.nodes, -1
        for stop in range(at + 1, len(word) + 1):
            node = nodes.get(word[at:stop])
            if node is None:
                break
            if node >= 0:
                token = node
        return token

    def path(self, word: bytes) -> list[int]:
        """The tokens along the one path whose labels spell ``word``."""
        arcs, size, shorter, length = self.arcs, self.size, self.shorter, self.length
        n, at = len(word), 0
        found: list[int] = []
        dead = set()
        while at < n:
            token = self._longest(word, at)
            while True:
                while token >= 0:
                    if not dead or at + length[token] not in dead:
                        if not found:
                            break
                        arc = arcs.get(found[-1] * size + token)
                        if self.has_arc(found[-1], token) if arc is None else arc:
                            break
                    token = shorter[token]
                if token >= 0:
                    break
                dead.add(at)
                if not found:
                    raise ValueError("a byte has no token")
                token = found.pop()
                at -= length[token]
                token = shorter[token]
            found.append(token)
            at += length[token]
        return found


class _Words(dict):
    """Ids of words as packed bytes; emptied when large."""

    def __init__(self, automaton: Automaton):
        self.automaton = automaton

    def __missing__(self, word: str) -> bytes:
        if len(self) >= MEMO_WORDS:
            self.clear()
        value = np.array(self.automaton.path(word.encode()), "<u4").tobytes()
        self[word] = value
        return value


def splitter(beyond: bool = True) -> re.Pattern:
    """The pre-split of byte-level BPE: contractions, letters, numbers, other signs, blanks.

    Letters and numbers are the Unicode categories L* and N*; blanks have the White_Space property.
    Without ``beyond`` the pattern is for texts with no character above U+FFFF, which it splits
    three times as fast.
    """
    ranges: dict[str, list[list[int]]] = {"L": [], "N": []}
    for code in range((sys.maxunicode if beyond else 0xFFFF) + 1):
        kind = unicodedata.category(chr(code))[0]
        if kind in ranges:
            if ranges[kind] and ranges[kind][-1][1] == code - 1:
                ranges[kind][-1][1] = code
            else:
                ranges[kind].append([code, code])
    letter, number = (
        "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges[kind]) for kind in "LN")
    # The characters with the White_Space property.
    blank = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
    return re.compile(
        f"'(?:[stmd]|re|ve|ll)| ?[{letter}]+| ?[{number}]+| ?[^{blank}{letter}{number}]+"
        f"|[{blank}]+(?![^{blank}])|[{blank}]+")


class Encoder:
    """A vocabulary with its automaton, its patterns and the words it has seen."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.words = _Words(Automaton(vocabulary))
        self.special = dict(vocabulary.specials)
        self._splitters: dict[bool, re.Pattern] = {}

    def split(self, text: bytes):
        """The pattern's ``findall`` for a text. Only characters above U+FFFF have bytes from 0xF0 on."""
        beyond = bool((np.frombuffer(text, np.uint8) >= 0xF0).any())
        if beyond not in self._splitters:
            self._splitters[beyond] = splitter(beyond)
        return self._splitters[beyond].findall


def _encoder(sent: Broadcast) -> Encoder:
    """The encoder of this worker. It is kept in the broadcast value, which a worker loads once, and so
    outlives the task that made it."""
    held = sent.value
    if "encoder" not in held:
        held["encoder"] = Encoder(held["vocabulary"])
    return held["encoder"]


def _send(frame: DataFrame, path: str) -> Broadcast:
    """Broadcasts the vocabulary, whose size the file bounds."""
    return frame.sparkSession.sparkContext.broadcast({"vocabulary": load(path)})


def packed_ids(text: bytes, encoder: Encoder) -> bytes:
    """Ids of a whole UTF-8 text, as little-endian unsigned 32-bit integers."""
    split, words, special = encoder.split(text), encoder.words, encoder.special
    names = sorted((n for n in special if n.encode() in text), key=len, reverse=True)
    if not names:
        return b"".join(map(words.__getitem__, split(text.decode())))
    parts = re.split("(" + "|".join(map(re.escape, names)) + ")", text.decode())
    return b"".join(
        special[part].to_bytes(4, "little") if k % 2 else
        b"".join(map(words.__getitem__, split(part)))
        for k, part in enumerate(parts))


def encode(docs: DataFrame, path: str, text: str = "text", column: str = "token_ids") -> DataFrame:
    """``docs`` with ``column`` added last: the packed ids of the text (null: empty)."""
    sent = _send(docs, path)
    names = docs.columns
    plain = docs.toDF(*[f"c{k}" for k in range(len(names))])
    at = names.index(text)

    def run(batches):
        encoder = _encoder(sent)
        for piece, texts in pieces(batches, f"c{at}"):
            ids = [packed_ids(t or b"", encoder) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*piece.columns, pa.array(ids, pa.binary())], [*piece.schema.names, "ids"])

    schema = plain.withColumn("ids", F.lit(b"")).schema
    return plain.mapInArrow(run, schema).toDF(*names, column)


def decode(rows: DataFrame, path: str, column: str = "token_ids", text: str = "decoded") -> DataFrame:
    """``rows`` with ``text`` added last: the labels of the arcs that the packed ids name."""
    sent = _send(rows, path)
    names = rows.columns
    plain = rows.toDF(*[f"c{k}" for k in range(len(names))])
    at = f"c{names.index(column)}"

    def run(batches):
        labels = sent.value["vocabulary"].labels
        for piece, packed in pieces(batches, at):
            texts = [
                b"".join(map(labels.__getitem__, np.frombuffer(p or b"", "<u4").tolist()))
                .decode("utf-8", "replace") for p in packed]
            yield pa.RecordBatch.from_arrays(
                [*piece.columns, pa.array(texts, pa.string())], [*piece.schema.names, "decoded"])

    schema = plain.withColumn("decoded", F.lit("")).schema
    return plain.mapInArrow(run, schema).toDF(*names, text)
