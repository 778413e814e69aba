"""Byte-pair encoding by dynamic programming over prefixes, and decoding.

For every prefix of a piece there is exactly one token that its encoding ends with.
The table of those last tokens is filled left to right: a suffix automaton of the
vocabulary gives the tokens that end at a position, and a candidate is right when
the pair (last token of what stands before it, candidate) survives the merges, that
is when no merge would ever have crossed the border between the two.  The ids are
read off by following the table backwards.

Texts are cut into pieces by the tokenizer file's own pre-tokenizer; added tokens
in a text are matched first.  Pieces repeat, so each Python worker keeps a bounded
table of pieces it has encoded; a miss is encoded, whatever its length.  The automaton is made once, as arrays
in a file that Spark sends to the executors; their workers map it and share its pages.

Rows: a null text counts as empty; empty texts have no ids.  Any number of further
columns is kept; a clashing output name raises ``ValueError``.  An empty table gives
an empty table.  Repeated rows are encoded independently.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import tempfile
from array import array
from collections.abc import Callable, Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CACHE_ENTRIES = 150_000      # pieces a worker remembers, in each of two generations
CACHE_PIECE = 96             # longer pieces are encoded anew each time
LEARN_ROWS = 500             # texts whose new pieces are encoded together
STEP_ENTRIES = 50_000        # states whose transitions or ends single pieces have asked for
TABLE_HEAD = 1024            # bytes before the arrays of a file of tables
PAIR_ENTRIES = 200_000       # pairs remembered for pieces encoded singly
PAIR_SLOTS = 1 << 22         # and, at most, for pieces encoded together


class SuffixAutomaton:
    """Suffix automaton of a set of byte strings, with the strings that end in each state."""

    def __init__(self, words: list[bytes]) -> None:
        self.step: list[dict[int, int]] = [{}]
        self.link: list[int] = [-1]
        self.depth: list[int] = [0]
        for word in words:
            at = 0
            for byte in word:
                at = self._extend(at, byte)
        self._place(words)

    def _state(self, depth: int, step: dict[int, int], link: int) -> int:
        self.step.append(step)
        self.link.append(link)
        self.depth.append(depth)
        return len(self.step) - 1

    def _split(self, above: int, below: int, byte: int) -> int:
        """A copy of ``below`` that holds only the strings up to one longer than ``above``'s."""
        step, link, depth = self.step, self.link, self.depth
        copy = self._state(depth[above] + 1, dict(step[below]), link[below])
        link[below] = copy
        while above >= 0 and step[above].get(byte) == below:
            step[above][byte] = copy
            above = link[above]
        return copy

    def _extend(self, last: int, byte: int) -> int:
        step, link, depth = self.step, self.link, self.depth
        known = step[last].get(byte)
        if known is not None:
            return known if depth[known] == depth[last] + 1 else self._split(last, known, byte)
        new = self._state(depth[last] + 1, {}, 0)
        at = last
        while at >= 0 and byte not in step[at]:
            step[at][byte] = new
            at = link[at]
        if at >= 0:
            below = step[at][byte]
            link[new] = below if depth[below] == depth[at] + 1 else self._split(at, below, byte)
        return new

    def _place(self, words: list[bytes]) -> None:
        """ends[s]: (length, word number) of the words in state s, longest first;
        up[s]: the nearest state above s that holds a word (-1: none)."""
        found: dict[int, list[tuple[int, int]]] = {}
        for number, word in enumerate(words):
            at = 0
            for byte in word:
                at = self.step[at][byte]
            found.setdefault(at, []).append((len(word), number))
        self.ends = {s: tuple(sorted(x, reverse=True)) for s, x in found.items()}
        self.up = [-1] * len(self.step)
        for s in sorted(range(1, len(self.step)), key=self.depth.__getitem__):
            above = self.link[s]
            self.up[s] = above if above in self.ends else self.up[above] if above >= 0 else -1


class _Steps(dict):
    """Transitions of the states that were asked for, from sorted edges."""

    def __init__(self, tables: dict[str, np.ndarray]) -> None:
        self.first, self.key, self.to = tables["edge_first"], tables["edge_key"], tables["edge_to"]

    def __missing__(self, state: int) -> dict[int, int]:
        a, b = int(self.first[state]), int(self.first[state + 1])
        if len(self) >= STEP_ENTRIES:
            self.clear()
        self[state] = dict(zip((self.key[a:b] & 0xFF).tolist(), self.to[a:b].tolist(), strict=True))
        return self[state]


def automaton_tables(words: list[bytes], ids: list[int]) -> dict[str, np.ndarray]:
    """The suffix automaton of a vocabulary as arrays: edges in the order of their state and byte, links, depths, and
    the tokens that end in each state, longest first."""
    auto = SuffixAutomaton(words)
    n = len(auto.step)
    edges = array("i", [0])
    key, to = array("i"), array("i")
    for state, step in enumerate(auto.step):
        for b in sorted(step):
            key.append(state << 8 | b)
            to.append(step[b])
        edges.append(len(key))
    first, size, token = array("i", [0]), array("h"), array("i")
    for state in range(n):
        at = state
        while at > 0:
            for length, number in auto.ends.get(at, ()):
                size.append(length)
                token.append(ids[number])
            at = auto.up[at]
        first.append(len(size))
    return {"edge_first": np.array(edges, np.int32), "edge_key": np.array(key, np.int32), "edge_to": np.array(to, np.int32),
            "link": np.array(auto.link, np.int32), "depth": np.array(auto.depth, np.int16),
            "first": np.array(first, np.int32), "size": np.array(size, np.int16), "token": np.array(token, np.int32)}


def save_tables(tables: dict[str, np.ndarray], path: str) -> None:
    """One file: a line of JSON that says where each array is, then the arrays."""
    place, head = 0, {}
    for name, x in tables.items():
        head[name] = (str(x.dtype), x.shape, place)
        place += -(-x.nbytes // 64) * 64
    line = json.dumps(head).encode()
    with open(path, "wb") as f:
        f.write(line.ljust(TABLE_HEAD - 1) + b"\n")
        for x in tables.values():
            f.write(x.tobytes().ljust(-(-x.nbytes // 64) * 64, b"\0"))


def open_tables(path: str) -> dict[str, np.ndarray]:
    """The arrays of a file, mapped: workers of one machine share its pages."""
    with open(path, "rb") as f:
        head = json.loads(f.readline())
    return {name: np.asarray(np.memmap(path, dtype, "r", TABLE_HEAD + at, tuple(shape))) for name, (dtype, shape, at) in head.items()}


class Tokenizer:
    """A byte-level BPE tokenizer file, encoded by prefix tables; ``tables``: a file of them, else they are made here."""

    def __init__(self, path: str, tables: str | None = None) -> None:
        self.tables_file = tables
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        if (model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True)
                or spec["normalizer"] or model.get("dropout") or model.get("ignore_merges")):
            raise ValueError(f"{path}: not a plain byte-level BPE file")
        self.byte_of = byte_alphabet()
        as_bytes = lambda s: bytes(self.byte_of[c] for c in s)
        self.bytes_of: dict[int, bytes] = {i: as_bytes(s) for s, i in model["vocab"].items()}
        self.added: dict[str, int] = {}
        for token in spec["added_tokens"]:
            if token["lstrip"] or token["rstrip"] or token["single_word"] or token["normalized"]:
                raise ValueError(f"{path}: added token {token['content']!r} has options")
            self.added[token["content"]] = token["id"]
            self.bytes_of[token["id"]] = token["content"].encode()
        self.added_pattern = re.compile("(" + "|".join(
            re.escape(x) for x in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        number = {s: i for s, i in model["vocab"].items()}
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        #: merged[left, right] = (time of the merge, id); parts[id] = (time, left, right)
        self.merged: dict[tuple[int, int], tuple[int, int]] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for time, (a, b) in enumerate(merges):
            pair, whole = (number[a], number[b]), number[a + b]
            self.merged.setdefault(pair, (time, whole))
            self.parts.setdefault(whole, (time, *pair))
        special = set(self.added.values())
        #: Only tokens that their own merges produce can be in an encoding.
        self.words = [i for i in sorted(self.bytes_of) if i not in special
                      and (i in self.parts or len(self.bytes_of[i]) == 1)]
        self.ending: dict[int, tuple[tuple[int, int], ...]] = {}
        self.fits: dict[tuple[int, int], bool] = {}
        self.spaced = _Pieces(self, " ")
        self.raw = _Pieces(self, "")

    @cached_property
    def cut(self) -> Callable[[str], list[tuple[str, tuple[int, int]]]]:
        """The library's byte-level pre-tokenizer."""
        from tokenizers.pre_tokenizers import ByteLevel

        return ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str

    @cached_property
    def arrays(self) -> dict[str, np.ndarray]:
        return open_tables(self.tables_file) if self.tables_file else automaton_tables([self.bytes_of[i] for i in self.words], self.words)

    @cached_property
    def step(self) -> _Steps:
        return _Steps(self.arrays)

    @cached_property
    def tables(self) -> _Tables:
        return _Tables(self)

    def compatible(self, left: int, right: int) -> bool:
        """Whether no merge crosses the border of two adjacent tokens.

        Undo the merges of both from the latest on.  At each moment a piece of ``left``
        and a piece of ``right`` touch; they would have been merged if their merge comes
        before the touching pieces were made part of larger ones.  Of equal times the
        one further left comes first.
        """
        parts, merged, never = self.parts, self.merged, 1 << 60
        gone_left = gone_right = never   # when the touching piece vanishes in a larger one
        fits = True
        while True:
            cross = merged.get((left, right))
            if cross is not None and cross[0] < gone_left and cross[0] <= gone_right:
                born = max(parts[x][0] if x in parts else -1 for x in (left, right))
                if cross[0] > born:
                    fits = False
                    break
            a, b = parts.get(left), parts.get(right)
            if a is None and b is None:
                break
            # of equal times, the right token's inner merge was made after the left one's
            if b is None or (a is not None and a[0] > b[0]):
                gone_left, left = a[0], a[2]
            else:
                gone_right, right = b[0], b[1]
        return fits

    def _remembered(self, left: int, right: int) -> bool:
        if len(self.fits) >= PAIR_ENTRIES:
            self.fits.clear()
        known = self.fits[left, right] = self.compatible(left, right)
        return known

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one piece: fill the table of last tokens, then walk it backwards."""
        fits, compatible = self.fits, self._remembered
        step, link, depth, ending = self.step, self.arrays["link"], self.arrays["depth"], self.ending
        n = len(piece)
        last, length = [0] * (n + 1), [0] * (n + 1)
        state = have = 0
        for i, byte in enumerate(piece, 1):
            while byte not in step[state]:
                if state == 0:
                    raise ValueError(f"byte {byte} is not in the vocabulary")
                state = int(link[state])
                have = int(depth[state])
            state = step[state][byte]
            have += 1
            for size, token in ending.get(state) or self.ending_at(state):
                if size <= have:
                    if size < i:
                        before = last[i - size]
                        fit = fits.get((before, token))
                        if not (compatible(before, token) if fit is None else fit):
                            continue
                    last[i], length[i] = token, size
                    break
            else:
                raise ValueError("no token ends at this byte")
        ids = []
        while n:
            ids.append(last[n])
            n -= length[n]
        ids.reverse()
        return ids

    def ending_at(self, state: int) -> tuple[tuple[int, int], ...]:
        """(length, id) of the tokens that are suffixes of a state's strings, longest first."""
        a, b = self.arrays["first"][state:state + 2].tolist()
        if len(self.ending) >= STEP_ENTRIES:
            self.ending.clear()
        self.ending[state] = tuple(zip(self.arrays["size"][a:b].tolist(), self.arrays["token"][a:b].tolist(), strict=True))
        return self.ending[state]

    def encode_unit(self, unit: str) -> array:
        """Ids of a run of white space and the word after it."""
        word = unit.rstrip(".,")
        if word.lstrip(" ").isalpha() and word[:2] != "  " and max(word) < LATIN_END:
            # a Latin word with one blank before it and stops after it: the pre-tokenizer's cuts
            ids = self.encode_piece(word.encode())
            return array("I", ids + self.encode_piece(unit[len(word):].encode()) if len(word) < len(unit) else ids)
        out = array("I")
        for shown, _ in self.cut(unit):
            out.extend(self.encode_piece(bytes(map(self.byte_of.__getitem__, shown))))
        return out

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text as unsigned 32-bit integers."""
        if not text:
            return np.empty(0, np.uint32)
        if self.added_pattern is None:
            return np.frombuffer(self._plain(text), np.uint32)
        parts = self.added_pattern.split(text) if any(x in text for x in self.added) else [text]
        packed = [self._plain(x) if k % 2 == 0 else array("I", [self.added[x]]).tobytes()
                  for k, x in enumerate(parts)]
        return np.frombuffer(b"".join(packed), np.uint32)

    def _plain(self, text: str) -> bytes:
        """Packed ids of a text without added tokens, unit by unit.

        A piece never runs on from a non-space into white space, so a run of white space
        and the word after it can be encoded by itself.  Where no white space stands next to
        other white space, cutting at single blanks gives the same units faster.
        """
        if not text:
            return b""
        if SPACE_RUN.search(text):
            return b"".join(map(self.raw.__getitem__, UNIT.findall(text)))
        units = blank_units(text)
        return self.raw[units[0]] + b"".join(map(self.spaced.__getitem__, units[1:]))

    def learn(self, texts: list[str]) -> None:
        """Encode the units of some texts that aren't remembered yet, the Latin words all at once."""
        units: set[str] = set()
        for text in texts:
            if not SPACE_RUN.search(text):
                units.update(blank_units(text))
        units.difference_update(self.spaced)
        known = self.spaced.older
        for unit in units & known.keys():
            self.spaced.keep(unit, known[unit])
        units.difference_update(known)
        line_end = self.raw["\n"]
        rows, words = [], []
        for unit in units:
            body = unit[1:] if unit[:1] == "\n" else unit
            word = body.rstrip(".,")
            if word.isalpha() and len(word) <= LONGEST // 2 and max(word) < LATIN_END:
                rows.append((unit, body[len(word):]))
                words.append((word if body is not unit else " " + word).encode())
        raw, spaced = self.raw, self.spaced
        for (unit, tail), packed in zip(rows, self.tables.encode(words), strict=True):
            if tail:
                packed += raw[tail]
            spaced.keep(unit, line_end + packed if unit[:1] == "\n" else packed)

    def encode_all(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of some texts as signed 32-bit integers; null texts have none."""
        known = [t or "" for t in texts]
        self.learn(known)
        return [self.encode(t).view(np.int32) for t in known]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


LATIN_END = "\u0250"   # letters below it are letters in every version of Unicode
LONGEST = 64           # bytes of a word that is encoded together with others
SPACE_RUN, UNIT = re.compile(r"\s\s"), re.compile(r"\s*\S+|\s+")


def blank_units(text: str) -> list[str]:
    """The first unit, then units with a blank before them, but for those that start with a line end."""
    return text.replace("\n", " \n").split(" ")


class _Tables:
    """The same prefix tables for many short Latin words at once, as arrays.

    Position by position, all words take their automaton step, then try the tokens
    that end there, longest first, until each has the one that fits.
    """

    def __init__(self, owner: Tokenizer) -> None:
        self.owner = owner
        self.edge_key, self.edge_to, self.link, self.depth, self.first, self.size, self.token = (
            owner.arrays[name] for name in ("edge_key", "edge_to", "link", "depth", "first", "size", "token"))
        self.keys = np.full(1 << 20, -1, np.int64)      # known pairs: open addressing
        self.fits = np.zeros(1 << 20, bool)
        self.known = 0

    def encode(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of each word."""
        if not words:
            return []
        sizes = np.array([len(w) for w in words])
        order = np.argsort(-sizes, kind="stable")
        n, sizes = len(words), sizes[order]
        width = int(sizes[0])
        text = np.frombuffer(b"".join(words[i].ljust(width) for i in order.tolist()), np.uint8).reshape(n, width)
        last, length = np.zeros((width + 1, n), np.int64), np.zeros((width + 1, n), np.int64)
        state, have = np.zeros(n, np.int32), np.zeros(n, np.int16)
        for i in range(1, width + 1):
            m = int(np.searchsorted(-sizes, -i, "right"))      # words of i bytes or more
            to = self._step(state[:m], text[:m, i - 1])
            stuck = np.flatnonzero(to < 0)
            while len(stuck):
                state[stuck] = self.link[state[stuck]]
                have[stuck] = self.depth[state[stuck]]
                to[stuck] = self._step(state[stuck], text[stuck, i - 1])
                stuck = stuck[to[stuck] < 0]
            state[:m] = to
            have[:m] += 1
            left, nth = np.arange(m), self.first[to]
            while len(left):
                size, token = (x[nth[left]].astype(np.int64) for x in (self.size, self.token))
                right = size <= have[left]
                inner = np.flatnonzero(right & (size < i))
                right[inner] = self._compatible(last[i - size[inner], left[inner]], token[inner])
                done = left[right]
                last[i, done], length[i, done] = token[right], size[right]
                left = left[~right]
                nth[left] += 1
        out, count, at, rows = np.zeros((width, n), np.uint32), np.zeros(n, np.int64), sizes.copy(), np.arange(n)
        while len(rows):
            count[rows] += 1
            out[width - count[rows], rows] = last[at[rows], rows]
            at[rows] -= length[at[rows], rows]
            rows = rows[at[rows] > 0]
        flat = np.ascontiguousarray(out.T).tobytes()
        result: list[bytes] = [b""] * n
        for k, (i, c) in enumerate(zip(order.tolist(), count.tolist(), strict=True)):
            result[i] = flat[4 * (width * (k + 1) - c):4 * width * (k + 1)]
        return result

    def _step(self, state: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The state after each byte, -1 if there is no such edge."""
        key = state << 8 | byte.astype(np.int32)
        at = np.minimum(np.searchsorted(self.edge_key, key), len(self.edge_key) - 1)
        return np.where(self.edge_key[at] == key, self.edge_to[at], np.int32(-1))

    def _compatible(self, before: np.ndarray, token: np.ndarray) -> np.ndarray:
        key = before << 20 | token
        slot = self._slot(key)
        new = np.flatnonzero(self.keys[slot] != key)
        if len(new):
            found = np.unique(key[new])
            compatible = self.owner.compatible
            self._add(found, np.array([compatible(k >> 20, k & 0xFFFFF) for k in found.tolist()]))
            slot = self._slot(key)
        return self.fits[slot]

    def _slot(self, key: np.ndarray) -> np.ndarray:
        """Where each key is, or the free place where it belongs."""
        top = len(self.keys) - 1
        slot = (key * 0x9E3779B1 >> 9) & top
        off = np.flatnonzero((self.keys[slot] != key) & (self.keys[slot] >= 0))
        while len(off):
            slot[off] = (slot[off] + 1) & top
            off = off[(self.keys[slot[off]] != key[off]) & (self.keys[slot[off]] >= 0)]
        return slot

    def _add(self, key: np.ndarray, fits: np.ndarray) -> None:
        """Enter pairs that aren't known yet; the table doubles before it is half full."""
        if (self.known + len(key)) * 2 > len(self.keys):
            held = self.keys >= 0 if len(self.keys) < PAIR_SLOTS else np.zeros(len(self.keys), bool)
            key, fits = np.concatenate([key, self.keys[held]]), np.concatenate([fits, self.fits[held]])
            grown = len(self.keys)
            while len(key) * 2 > grown:
                grown *= 2
            self.keys, self.fits, self.known = np.full(grown, -1, np.int64), np.zeros(grown, bool), 0
        self.known += len(key)
        while len(key):
            slot, one = np.unique(self._slot(key), return_index=True)
            self.keys[slot], self.fits[slot] = key[one], fits[one]
            rest = np.ones(len(key), bool)
            rest[one] = False
            key, fits = key[rest], fits[rest]


class _Pieces(dict):
    """Packed ids by unit; ``lead`` stands before each unit, unless it starts with a line end.

    When full, what it holds becomes the older generation, from which units in use come back.
    """

    def __init__(self, owner: Tokenizer, lead: str) -> None:
        self.owner, self.lead = owner, lead
        self.older: dict[str, bytes] = {}

    def __missing__(self, unit: str) -> bytes:
        packed = self.older.get(unit)
        if packed is None:
            whole = unit if self.lead and unit[:1] == "\n" else self.lead + unit
            packed = self.owner.encode_unit(whole).tobytes() if whole else b""
        if len(unit) <= CACHE_PIECE:
            self.keep(unit, packed)
        return packed

    def keep(self, unit: str, packed: bytes) -> None:
        if len(self) >= CACHE_ENTRIES:
            self.older = dict(self)
            self.clear()
        self[unit] = packed


def byte_alphabet() -> dict[str, int]:
    """The printable characters that stand for the 256 bytes in byte-level files: printable
    Latin-1 stands for itself, the others follow from U+0100 on in ascending order."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + k): b for k, b in enumerate(hidden)}


def _tables_name(path: str) -> str:
    with open(path, "rb") as f:
        return f"bpe-tables-{hashlib.sha256(f.read()).hexdigest()[:16]}"


@lru_cache(maxsize=4)
def tokenizer(path: str) -> Tokenizer:
    """One tokenizer per worker process and file, over the tables that ``ship_tables`` sent, if it did."""
    sent = SparkFiles.get(_tables_name(path)) if SparkFiles._is_running_on_worker else ""
    return Tokenizer(path, sent if os.path.exists(sent) else None)


_sent: set[tuple[str, str]] = set()


def ship_tables(spark: SparkSession, path: str) -> None:
    """Make a tokenizer's tables once, on the driver, and send them with Spark's own file distribution: each
    executor gets one copy, which its workers map."""
    name = _tables_name(path)
    app = spark.sparkContext.applicationId
    if (app, name) not in _sent:
        place = os.path.join(tempfile.mkdtemp(prefix="tables-"), name)
        save_tables(Tokenizer(path).arrays, place)
        spark.sparkContext.addFile(place)
        _sent.add((app, name))


def token_ids(text: Column, tokenizer_path: str) -> Column:
    """Ids of a text column as ``array<int>``; null texts give an empty array."""

    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tok = tokenizer(tokenizer_path)
        for batch in batches:
            for at in range(0, len(batch), LEARN_ROWS):
                yield _id_lists(tok.encode_all(batch.slice(at, LEARN_ROWS).to_pylist()))

    return F.arrow_udf(ids, "array<int>")(text)


def _id_lists(ids: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int32), *ids])))


def decoded_text(ids: Column, tokenizer_path: str) -> Column:
    """Text of an id column (``array<int>``, special tokens included); null ids give ''."""

    def texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tok = tokenizer(tokenizer_path)
        for batch in batches:
            yield pa.array((tok.decode(x.values.to_numpy(zero_copy_only=False).tolist() if x.is_valid else ())
                            for x in batch), pa.string(), size=len(batch))

    return F.arrow_udf(texts, "string")(ids)


def _free(df: DataFrame, *names: str) -> None:
    clash = {c.lower() for c in df.columns} & {n.lower() for n in names}
    if clash:
        raise ValueError(f"output columns already exist: {sorted(clash)}")


def encode(df: DataFrame, tokenizer_path: str, text_col: str = "text", ids_col: str = "token_ids") -> DataFrame:
    """``df`` with the ids of its texts.  No shuffle; each batch of rows is encoded by itself."""
    _free(df, ids_col)
    ship_tables(df.sparkSession, tokenizer_path)
    return df.withColumn(ids_col, token_ids(F.col(text_col), tokenizer_path))


def decode(df: DataFrame, tokenizer_path: str, ids_col: str = "token_ids", text_col: str = "decoded") -> DataFrame:
    """``df`` with the text of its ids."""
    _free(df, text_col)
    return df.withColumn(text_col, decoded_text(F.col(ids_col), tokenizer_path))


def encode_and_decode(df: DataFrame, tokenizer_path: str, text_col: str = "text", ids_col: str = "token_ids",
                      decoded_col: str = "decoded") -> DataFrame:
    """``encode`` and then ``decode``, in one pass of the Python workers."""
    _free(df, ids_col, decoded_col)
    ship_tables(df.sparkSession, tokenizer_path)

    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tok = tokenizer(tokenizer_path)
        for batch in batches:
            for at in range(0, len(batch), LEARN_ROWS):
                ids = _id_lists(tok.encode_all(batch.slice(at, LEARN_ROWS).to_pylist()))
                ends, values = ids.offsets.to_pylist(), ids.values.to_numpy()
                texts = pa.array([tok.decode(values[a:b].tolist()) for a, b in zip(ends, ends[1:])], pa.string())
                yield pa.StructArray.from_arrays([ids, texts], ["ids", "text"])

    pair = F.arrow_udf(both, "struct<ids:array<int>,text:string>")(F.col(text_col))
    return df.withColumn(ids_col, pair).withColumn(decoded_col, F.col(ids_col)["text"]).withColumn(ids_col, F.col(ids_col)["ids"])


def bpe_digests(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Encode then decode every document; return counts and digests of ids and decoded text."""
    both = encode_and_decode(docs.select("doc_id", "text"), tokenizer_path)
    return both.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("token_ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
