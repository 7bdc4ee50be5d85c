"""BPE by a tokenization automaton: merges are compiled into forbidden successions of arcs.

The automaton starts with one arc per base symbol, any arc after any other.  The gadget of merge
(u, v) -> uv, taken in rank order, adds the arc uv and takes the arc v away wherever u came in.  What it
takes away holds for every arc that still ends in u and every arc that still begins with v at that
moment, so a succession (a, b) is open exactly if no gadget met a right edge of a with a left edge of b.
The full table has |V|^2 cells; the edges of every arc are compiled once, the cells on first use.
Each string has one path of open successions, and so has what stands before any place of it: the walk goes
forward by the longest open arc, back where none is open, and never comes to a place twice.  Decoding emits the labels of the arcs.

Null text: no tokens, both digests of the empty string.  Documents are handled whole and alone (one map).
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from provlake.llm.common import per_text
from provlake.llm.secrets import vocabulary_path

#: Bounds on what a worker remembers: words of the last texts, in two halves of which the older one is left when the newer one has this many,
#: and the first cells that it meets.  Others are worked out each time.
CACHED_WORDS = 200_000
CACHED_CELLS = 300_000
#: First symbols that tell which lengths an arc may have.
HEAD = 3
_BLANK = r"\p{White_Space}"


def _byte_symbols() -> list[str]:
    """The usual printable stand-ins of the 256 byte values."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(rest)) for b in range(256)]


class MergeAutomaton:
    def __init__(self, spec: dict):
        model = spec["model"]
        self.end: str = model.get("end_of_word_suffix") or ""
        self.ids: dict[str, int] = model["vocab"]
        self.label = {i: t for t, i in self.ids.items()} | {a["id"]: a["content"] for a in spec["added_tokens"]}
        self.added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.merge: dict[tuple[int, int], int] = {}
        parts: dict[int, tuple[int, int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            u, v = pair if isinstance(pair, list) else pair.split(" ")
            arc = (self.ids[u], self.ids[v])
            self.merge[arc] = rank
            parts[self.ids[u + v]] = (*arc, rank)
        self.parts = parts
        self.longest = max(len(t) for t in self.ids)
        self.plain = {t: i for t, i in self.ids.items() if not (self.end and t.endswith(self.end))}
        self.final = {t[: len(t) - len(self.end)]: i for t, i in self.ids.items() if t.endswith(self.end)} if self.end else self.plain
        self.open: dict[int, bool] = {}
        self.edges: tuple[dict, dict] = ({}, {})
        added = "|".join(regex.escape(a) for a in self.added)
        self.special = regex.compile(f"({added})") if added else None
        pieces = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.split = regex.compile(pieces.replace(r"[^\s\p{L}\p{N}]", rf"[^{_BLANK}\p{{L}}\p{{N}}]"))
        #: Beyond these, case and letters differ between versions of Unicode: the tokenizer's own pre-split is taken.
        self.rare = regex.compile(r"[^\x00-\u024F\u2010-\u2027\u2030-\u205E\u20A0-\u20BF]|\u0130")
        #: The same pieces in small ASCII text, where nothing else can stand.
        ascii_only = pieces.replace(r"[^\s\p{L}\p{N}]", r"[^\x09-\x0D\x20a-z0-9]").replace(r"[\p{L}]", "[a-z]").replace(r"[\p{N}]", "[0-9]")
        self.split_ascii = self.split if r"\p" in ascii_only or r"\s" in ascii_only else re.compile(ascii_only)
        self.library = Tokenizer.from_str(json.dumps(spec))
        self.symbols = _byte_symbols()
        self.stand_in = dict(enumerate(self.symbols))
        self.number = {i: str(i) for i in self.label}
        #: Ids and labels of known words, each joined by spaces.
        self.words: tuple[dict[str, str], dict[str, str]] = ({}, {})
        self.older: tuple[dict[str, str], dict[str, str]] = ({}, {})
        # arcs that the gadgets never build from base symbols are no arcs
        self.made: dict[int, bool] = {}
        self.plain = {t: i for t, i in self.plain.items() if self._reaches(i)}
        self.final = {t: i for t, i in self.final.items() if self._reaches(i)}
        self.made.clear()
        #: Lengths of the arcs inside a word, the greatest first, by their first HEAD symbols.
        self.lengths: dict[str, tuple[int, ...]] = {}
        short = tuple(range(HEAD - 1, 0, -1))
        for t in sorted(self.plain, key=len):
            if len(t) >= HEAD and (got := self.lengths.get(t[:HEAD], short))[0] < len(t):
                self.lengths[t[:HEAD]] = (len(t), *got)

    def _edge(self, arc: int, side: int) -> list[tuple[int, float]]:
        """Arcs on the right (side 1) or left (0) edge of arc, each with the rank of the gadget that absorbs it."""
        if (got := self.edges[side].get(arc)) is None:
            got, until, at = [], float("inf"), arc
            while True:
                got.append((at, until))
                if at not in self.parts:
                    break
                until, at = self.parts[at][2], self.parts[at][side]
            self.edges[side][arc] = got
        return got

    def opens(self, a: int, b: int) -> bool:
        """Whether arc b may follow arc a once all gadgets are in.  Equal ranks: the left pair merges first."""
        cell = a << 32 | b
        if (got := self.open.get(cell)) is None:
            merge = self.merge
            got = True
            for u, gone in self._edge(a, 1):
                for v, lost in self._edge(b, 0):
                    rank = merge.get((u, v))
                    if rank is not None and rank < gone and rank <= lost:
                        got = False
                        break
                if not got:
                    break
            if len(self.open) < CACHED_CELLS:
                self.open[cell] = got
        return got

    def walk(self, s: str) -> list[int]:
        """The arcs of one pre-split word, given as symbols of its bytes.  One arc at most can end at each place, so a place that leads nowhere is left for good."""
        n = len(s)
        if not n:
            return []
        final, plain, memo, lengths = self.final.get, self.plain.get, self.open.get, self.lengths.get
        if (whole := final(s)) is not None:
            return [whole]
        short, longest = range(HEAD - 1, 0, -1), self.longest
        arcs: list[int] = []
        trail: list[tuple] = []  # where each arc begins, and the lengths left to try there
        dead: set[int] = set()
        at, before = 0, -1
        while True:
            if before >= 0 and n - at <= longest and (arc := final(s[at:])) is not None:
                ok = memo(before << 32 | arc)
                if self.opens(before, arc) if ok is None else ok:
                    arcs.append(arc)
                    return arcs
            left = iter(lengths(s[at : at + HEAD], short))
            while True:
                for length in left:
                    end = at + length
                    if end < n and end not in dead and (arc := plain(s[at:end])) is not None:
                        if before < 0:
                            break
                        ok = memo(before << 32 | arc)
                        if self.opens(before, arc) if ok is None else ok:
                            break
                else:
                    if not trail:
                        raise ValueError(f"no path for {s!r}")
                    dead.add(at)
                    at, left = trail.pop()
                    arcs.pop()
                    before = arcs[-1] if arcs else -1
                    continue
                break
            trail.append((at, left))
            arcs.append(arc)
            at, before = end, arc

    def _reaches(self, arc: int) -> bool:
        """Whether gadgets build the arc from base symbols: the two parts must be open to that very gadget only."""
        if (got := self.made.get(arc)) is None:
            if arc not in self.parts:
                got = True
            else:
                u, v, rank = self.parts[arc]
                got = self._reaches(u) and self._reaches(v)
                if got:
                    for a, gone in self._edge(u, 1):
                        for b, lost in self._edge(v, 0):
                            r = self.merge.get((a, b))
                            if r is not None and r < rank and r < gone and r <= lost:
                                got = False
            self.made[arc] = got
        return got

    def _learn(self, new: set, words: Callable[[str], str]) -> None:
        """new: words that are to be known; words: the symbols of each."""
        if len(self.words[0]) >= CACHED_WORDS:
            self.words, self.older = ({}, {}), self.words
        (ids, labels), (old_ids, old_labels) = self.words, self.older
        for w in new:
            if (got := old_ids.get(w)) is not None:
                ids[w], labels[w] = got, old_labels[w]
                continue
            arcs = self.walk(words(w))
            ids[w], labels[w] = " ".join([self.number[i] for i in arcs]), " ".join([self.label[i] for i in arcs])

    def _symbols(self, word: str) -> str:
        if word.isascii() and word.isprintable():
            return word  # these bytes stand for themselves
        return word.encode("utf-8", "replace").decode("latin-1").translate(self.stand_in)

    def _run(self, text: str, ids: list[str], labels: list[str]) -> None:
        words = self._symbols
        if self.rare.search(text):
            # symbols already, kept apart from words by a blank
            found = [f" {w}" for w, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))]
            words = lambda w: w[1:]
        elif text.isascii():
            found = self.split_ascii.findall(text.lower())
        else:
            found = self.split.findall(unicodedata.normalize("NFC", text).lower())
        if not found:
            return
        every = set(found)
        if new := every.difference(self.words[0]):
            if len(self.words[0]) >= CACHED_WORDS:
                new = every
            self._learn(new, words)
        ids.append(" ".join(map(self.words[0].__getitem__, found)))
        labels.append(" ".join(map(self.words[1].__getitem__, found)))

    def encode(self, text: str) -> tuple[str, str]:
        """Ids and arc labels, each joined by spaces."""
        ids: list[str] = []
        labels: list[str] = []
        for piece in self.special.split(text) if self.special and "<" in text else [text]:
            if piece in self.added:
                ids.append(str(self.added[piece]))
                labels.append(piece)
            elif piece:
                self._run(piece, ids, labels)
        return " ".join(ids), " ".join(labels)

    def decode(self, ids: str) -> str:
        return " ".join(self.label[int(i)] for i in ids.split())


@lru_cache(2)
def automaton(path: str) -> MergeAutomaton:
    with open(path, encoding="utf-8") as f:
        return MergeAutomaton(json.load(f))


def encode_documents(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """One row per document: n_tokens, the ids as an array of int, and the decoded text."""
    path = vocabulary or vocabulary_path("word_bpe_49k.json")

    def run(text: str) -> tuple:
        ids, labels = automaton(path).encode(text)
        ints = np.array(ids.split(), dtype=np.int32)
        return len(ints), ints, labels

    return per_text(docs, run, "n_tokens long, ids array<int>, decoded string")


def encode_digests(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """As encode_documents, with digests in place of the ids and the decoded text."""
    path = vocabulary or vocabulary_path("word_bpe_49k.json")

    def run(text: str) -> tuple:
        ids, labels = automaton(path).encode(text)
        n = ids.count(" ") + 1 if ids else 0
        return n, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(labels.encode("utf-8", "replace")).hexdigest()

    return per_text(docs, run, "n_tokens long, ids_sha256 string, decoded_sha256 string")
