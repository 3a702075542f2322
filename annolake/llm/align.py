"""Operator 12, alignment of two tokenizers by as-of merges of token starts.

Tokenizer A is a byte-level BPE, B a sentencepiece BPE with byte fallback. A task takes
its documents in frames of bounded size; a frame holds the tokens of both sides with
their byte offsets, documents one after the other. ``merge_asof``, keyed by
document, finds for each token start of one side the covering token of the other; the
union of both directions holds each overlapping pair once. Ends that both sides share
close a group.

How many documents hold a pair is counted over the corpus: each block of documents (one
Arrow batch) has a dictionary of its distinct pairs, the dictionaries are
summed by pair, and the counts travel back by dictionary, not by link.

Distinct units are encoded once. A unit is a run of spaces or line feeds and the characters
up to the next one. Where a unit ends in a character that is surely no white space, neither tokenizer
merges across its end: A's pattern parts words before white space, and no piece of B holds a
mark after another character or a line feed (checked when the model is read). Otherwise it is joined with the next.
"""

from __future__ import annotations

import hashlib
import json
import re
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from annolake.llm.common import per_worker, text_batches
from annolake.session import cut_lineage

BYTE_MODEL, PIECE_MODEL = "byte_bpe_50k.json", "piece_bpe_32k.model"
MARK = "▁"
FRAME = 1 << 18       # characters of texts whose tokens are merged at once; longer texts take several frames
CACHE_ENTRIES = 120_000
BLOCK_BYTES = 2 << 20
ROW = 64              # units encoded as one text

# A boundary needs a character from these ranges (no white space in any definition of it) before it.
_SURE = "!-~¡-ɏͰ-ԯ一-鿿가-힣"
_UNITS = re.compile(r"[ \n]+[^ \n]*")
_OPEN_END = re.compile(rf"[^{_SURE}]\Z")
_ANY_OPEN_END = re.compile(rf"[^{_SURE} \n][ \n]")


def _byte_alphabet() -> dict[str, int]:
    """Character -> byte of the byte-level alphabet: printable bytes stand for themselves, the others, in order, for 256 and on."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(own)]
    return {**{chr(b): b for b in own}, **{chr(256 + k): b for k, b in enumerate(rest)}}


class Pair:
    """Both tokenizers with the bytes of their tokens."""

    def __init__(self, byte_model: str | None = None, piece_model: str | None = None):
        import sentencepiece
        from tokenizers import Tokenizer

        if byte_model is None or piece_model is None:
            import public_tokenizers
            byte_model = byte_model or public_tokenizers.path(BYTE_MODEL)
            piece_model = piece_model or public_tokenizers.path(PIECE_MODEL)
        self.a = Tokenizer.from_file(byte_model)
        self.a.encode_special_tokens = True
        alphabet = _byte_alphabet()
        with open(byte_model, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        self.size_a = max(vocab.values()) + 1
        self.bytes_a = [b""] * self.size_a
        for token, i in vocab.items():
            self.bytes_a[i] = bytes(alphabet[c] for c in token)
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_model)
        self.size_b = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(self.size_b)]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        self.mark = self.b.piece_to_id(MARK)
        self.whole = any(MARK in p.lstrip(MARK) or "\n" in p for p in pieces)
        self.len_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.len_b = np.array([len(x) for x in self.bytes_b], np.int64)
        self.names_a, self.names_b = ([np.array([f"{i}{sep}" for i in range(n)], object) for sep in seps]
                                      for n, seps in ((self.size_a, ",|"), (self.size_b, ",;")))

    def units(self, text: str) -> list[str]:
        """The parts of space + ``text`` that both tokenizers take alone."""
        if self.whole:
            return [" " + text]
        parts = _UNITS.findall(" " + text)
        if not _ANY_OPEN_END.search(text):
            return parts
        out, now = [], []
        for p in parts:
            now.append(p)
            if not _OPEN_END.search(p):
                out.append("".join(now))
                now = []
        return [*out, "".join(now)] if now else out

    def encode(self, units: list[str]):
        """``units`` in some order, their ids and bounds on both sides, and whether the tokens give back each unit's bytes.

        Units are parts that both tokenizers take alone, so a row of them is encoded as one text and cut at their ends; where the
        bytes of a row do not come back, its units are encoded one by one.
        """
        ends = [k + 1 for k, u in enumerate(units) if k % ROW == ROW - 1 or _OPEN_END.search(u)]
        rows = [units[lo:hi] for lo, hi in zip([0, *ends], [*ends, len(units)]) if lo < hi]
        found = self._encode(["".join(r) for r in rows])
        fine = [all(self._bytes(of, ids[k]) == "".join(r).encode() for of, ids in zip((self.bytes_a, self.bytes_b), found)) for k, r in enumerate(rows)]
        names = [u for r, ok in zip(rows, fine) if ok for u in r]
        bounds, flat, size = np.cumsum([len(u.encode()) for u in names]), [], []
        for ids, lengths in zip(found, (self.len_a, self.len_b)):
            f = np.fromiter(chain.from_iterable(x for x, ok in zip(ids, fine) if ok), np.int64)
            at = np.searchsorted(np.cumsum(lengths[f]), bounds)
            flat.append(f)
            size.append(np.diff(at, prepend=-1))
        alone = [u for r, ok in zip(rows, fine) if not ok for u in r]
        found = self._encode(alone)
        good = [all(self._bytes(of, ids[k]) == u.encode() for of, ids in zip((self.bytes_a, self.bytes_b), found)) for k, u in enumerate(alone)]
        flat = [np.concatenate([f, np.fromiter(chain.from_iterable(ids), np.int64)]) for f, ids in zip(flat, found)]
        size = [np.concatenate([n, np.fromiter(map(len, ids), np.int64, len(ids))]) for n, ids in zip(size, found)]
        return names + alone, flat, size, np.array([True] * len(names) + good, bool)

    def _encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of texts that begin with white space; B itself puts a mark before each."""
        ids_a = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        ids_b = self.b.encode([t[1:] if t[0] == " " else t for t in texts], num_threads=1)
        for k, t in enumerate(texts):
            if t == " ":
                ids_b[k] = [self.mark]      # nothing is left to encode, so there is no mark
            elif t[0] != " " and ids_b[k][:1] == [self.mark]:
                ids_b[k] = ids_b[k][1:]
        return ids_a, ids_b

    @staticmethod
    def _bytes(of: list[bytes], ids: list[int]) -> bytes:
        return b"".join(map(of.__getitem__, ids))


class Units:
    """Encoded units that a task remembers. Where they get too many, the half that was used most stays; the bounds only save time and memory."""

    def __init__(self, pair: Pair, entries: int = CACHE_ENTRIES, characters: int = 4 << 20):
        self.pair, self.entries, self.characters = pair, entries, characters
        self.keep(None)

    def keep(self, at: np.ndarray | None) -> None:
        none = np.zeros(0, np.int64)
        if at is None:
            self.slot, self.flat, self.size, self.ok, self.used = {}, [none, none], [none, none], np.zeros(0, bool), none
        else:
            names = list(self.slot)
            self.slot = {names[k]: i for i, k in enumerate(at.tolist())}
            self.flat = [_spread(f, n, at) for f, n in zip(self.flat, self.size)]
            self.size, self.ok, self.used = [n[at] for n in self.size], self.ok[at], self.used[at]
        self.room = self.characters - sum(map(len, self.slot))

    def find(self, units: list[str]) -> np.ndarray:
        """Places of ``units`` in ``size`` and ``ok``."""
        if self.room < 0:
            self.keep(None)
        elif len(self.slot) > self.entries:
            self.keep(np.argsort(-self.used, kind="stable")[:self.entries // 2])
        new = [u for u in dict.fromkeys(units) if u not in self.slot]
        if new:
            new, flat, size, ok = self.pair.encode(new)
            self.slot.update(zip(new, range(len(self.slot), len(self.slot) + len(new))))
            self.room -= sum(map(len, new))
            self.flat, self.size = ([np.concatenate(x) for x in zip(*y)] for y in ((self.flat, flat), (self.size, size)))
            self.ok = np.concatenate([self.ok, ok])
        at = np.fromiter(map(self.slot.__getitem__, units), np.int64, len(units))
        self.used = np.bincount(at, minlength=len(self.slot)) + np.pad(self.used, (0, len(self.slot) - len(self.used)))
        return at


def _spread(flat: np.ndarray, size: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The parts ``at`` of ``flat``, which holds parts of the given sizes, one after the other."""
    first = np.cumsum(size) - size
    n = size[at]
    return flat[np.repeat(first[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())]


def overlaps(doc_a, start_a, a, doc_b, start_b, b) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, a, b) of all overlapping token pairs: starts ascending, each document's first starts equal."""
    left, right = pd.DataFrame({"doc": doc_a, "start": start_a, "a": a}), pd.DataFrame({"doc": doc_b, "start": start_b, "b": b})
    covered = pd.merge_asof(left, right, on="start", by="doc")
    back = pd.merge_asof(right, left.assign(own=start_a), on="start", by="doc")
    back = back[back["own"] != back["start"]]          # equal starts are in the other direction
    return tuple(np.concatenate([covered[c].to_numpy(np.int64), back[c].to_numpy(np.int64)]) for c in ("doc", "a", "b"))


class Document:
    """What is known of a text whose frames have come so far."""

    def __init__(self, digest: bool):
        self.ok, self.n, self.sha, self.text, self.pairs = True, [0, 0, 0, 0], hashlib.sha256() if digest else None, [], []

    def take(self, counts, text: str, pairs, times) -> None:
        part = (";" if self.n[2] else "") + text
        self.n = [x + int(y) for x, y in zip(self.n, counts)]
        if self.sha:
            self.sha.update(part.encode())
        else:
            self.text.append(part)
        self.pairs.append((pairs, times))

    def result(self):
        """n_a, n_b, n_groups, n_links, groups; distinct pairs ascending and how often each is linked."""
        if not self.ok or not self.pairs:
            return [0, 0, 0, 0, ""], np.zeros(0, np.int64), np.zeros(0, np.int64)
        pairs, times = (np.concatenate(x) for x in zip(*self.pairs))
        if len(self.pairs) > 1:
            pairs, at = np.unique(pairs, return_inverse=True)
            times = np.bincount(at, times).astype(np.int64)
        return [*self.n, self.sha.hexdigest() if self.sha else "".join(self.text)], pairs, times


def align_frame(known: Units, docs: list[Document], at: list[int], units: list[str]) -> None:
    """Align ``units``, of documents ``at``, and give the documents what was found."""
    pair, unit, doc = known.pair, known.find(units), np.array(at)
    for d in np.unique(doc[~known.ok[unit]]):
        docs[d].ok = False
    fine = np.array([d.ok for d in docs])[doc]
    unit, doc = unit[fine], doc[fine]
    if not len(unit):
        return
    a, b = (_spread(f, s, unit) for f, s in zip(known.flat, known.size))
    doc_a, doc_b = (np.repeat(doc, s[unit]) for s in known.size)
    end_a, end_b = np.cumsum(pair.len_a[a]), np.cumsum(pair.len_b[b])
    link_doc, link_a, link_b = overlaps(doc_a, end_a - pair.len_a[a], a, doc_b, end_b - pair.len_b[b], b)
    last_a, last_b = np.isin(end_a, end_b, assume_unique=True), np.isin(end_b, end_a, assume_unique=True)
    group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    n = int(last_a.sum())
    before_a, before_b = (np.concatenate([[0], np.cumsum(np.bincount(g, minlength=n))]) for g in (group_a, group_b))
    names = np.empty(len(a) + len(b), object)
    names[np.arange(len(a)) + before_b[group_a]] = np.where(last_a, pair.names_a[1][a], pair.names_a[0][a])
    names[np.arange(len(b)) + before_a[group_b + 1]] = np.where(last_b, pair.names_b[1][b], pair.names_b[0][b])
    names = names.tolist()
    space = pair.size_a * pair.size_b
    keys, times = np.unique(link_doc * space + link_a * pair.size_b + link_b, return_counts=True)
    present = np.unique(doc)
    bounds = [np.searchsorted(x, [present, present + 1]) for x in (doc_a, doc_b, keys // space)]
    groups = np.bincount(doc_a[last_a], minlength=present[-1] + 1)
    links = np.bincount(link_doc, minlength=present[-1] + 1)
    for k, d in enumerate(present):
        (a0, a1), (b0, b1), (k0, k1) = (x[:, k] for x in bounds)
        text = "".join(names[a0 + b0:a1 + b1])[:-1]
        docs[d].take((a1 - a0, b1 - b0, groups[d], links[d]), text, keys[k0:k1] - d * space, times[k0:k1])


def align_block(known: Units, texts: list[str | None], digest: bool, frame: int = FRAME) -> list[Document]:
    docs, at, units, n = [Document(digest) for _ in texts], [], [], 0
    for d, t in enumerate(texts):
        own = known.pair.units(t) if t else []
        if n + len(t or "") < frame:
            at += [d] * len(own)
            units += own
            n += len(t or "")
            continue
        for u in own:
            at.append(d)
            units.append(u)
            n += len(u)
            if n >= frame:
                align_frame(known, docs, at, units)
                at, units, n = [], [], 0
    if units:
        align_frame(known, docs, at, units)
    return docs


def aligned(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", byte_model: str | None = None, piece_model: str | None = None,
            with_groups: bool = False) -> DataFrame:
    """(block, doc_id, n_a, n_b, n_groups, n_links, groups, pairs, times, keys, held), one row for each row of ``docs``.

    ``groups``: ``a1,a2|b1;a3|b2,b3`` or, without ``with_groups``, its lowercase SHA-256. ``pairs`` (little-endian 32-bit,
    each less the one before) are places in the block's dictionary, ``times`` how often each is linked. The block's first row has the
    dictionary: ``keys`` (id of A * vocabulary of B + id of B) and the number ``held`` of the block's documents with each.
    """
    names = ["n_a", "n_b", "n_groups", "n_links"]

    def run(batches):
        from pyspark import TaskContext

        known, part, block = None, TaskContext.get().partitionId(), 0
        for batch in batches:
            known = known or Units(per_worker(("align", byte_model, piece_model), lambda: Pair(byte_model, piece_model)))
            found = [d.result() for d in align_block(known, batch.column(1).to_pylist(), not with_groups)]
            keys, at, held = np.unique(np.concatenate([p for _, p, _ in found]), return_inverse=True, return_counts=True)
            places = np.split(at.astype("<i4"), np.cumsum([len(p) for _, p, _ in found])[:-1])
            first = [[*x] + [None] * (len(found) - 1) for x in ([keys], [held])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + block] * len(found)), batch.column(0), *[pa.array([r[k] for r, _, _ in found], pa.int64()) for k in range(4)],
                 pa.array([r[4] for r, _, _ in found], pa.string()), pa.array([np.diff(p, prepend=np.int32(0)).tobytes() for p in places], pa.binary()),
                 pa.array([t.astype("<i4").tobytes() for _, _, t in found], pa.binary()), *[pa.array(x, pa.list_(pa.int64())) for x in first]],
                names=["block", "doc_id", *names, "groups", "pairs", "times", "keys", "held"])
            block += 1

    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    text_batches(d.sparkSession, BLOCK_BYTES)
    kind = d.schema["doc_id"].dataType.simpleString()
    return d.mapInArrow(run, f"block bigint, doc_id {kind}, " + ", ".join(f"{n} bigint" for n in names)
                        + ", groups string, pairs binary, times binary, keys array<bigint>, held array<bigint>")


def pair_counts(found: DataFrame, size_b: int) -> DataFrame:
    """(key, n, best): the documents that hold each pair linked, and whether that is its A id's highest count. An A id has at
    most as many pairs as B has ids, so the window's groups are bounded by the vocabulary."""
    each = found.where("keys is not null").select(F.explode(F.arrays_zip("keys", "held")).alias("e"))
    n = each.groupBy(F.col("e.keys").alias("key")).agg(F.sum("e.held").alias("n"))
    top = F.max("n").over(Window.partitionBy(F.expr(f"key div {size_b}")))
    return n.withColumn("best", F.col("n") == top)


def align(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", byte_model: str | None = None, piece_model: str | None = None,
          with_groups: bool = False) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups), one row for each row of ``docs``, whole texts.

    ``groups`` as in ``aligned``. A text that is null or empty, or whose tokens on either side do not give back
    the bytes of space + text, has no tokens: zeros and an empty string, and it holds no pair. Each row is a document of its own: repeated rows
    are repeated and counted, ids may be null. Long texts are aligned in frames. Empty table: empty result; other columns are not read.
    """
    size_b = Pair(byte_model, piece_model).size_b
    found = cut_lineage(aligned(docs, doc_id, text, byte_model, piece_model, with_groups), "aligned")
    counts = pair_counts(found, size_b)
    asked = found.where("keys is not null").select(F.col("block").alias("of"), F.posexplode("keys").alias("pos", "key"))
    told = asked.join(counts, "key").select("of", "pos", "n", "best")
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
    kind = found.schema["doc_id"].dataType.simpleString()

    def weigh(left: pa.Table, right: pa.Table) -> pa.Table:
        order = np.argsort(right.column("pos").to_numpy())
        n, best = right.column("n").to_numpy()[order], right.column("best").to_numpy()[order]
        sums, tops = [], []
        for p, t in zip(left.column("pairs").to_pylist(), left.column("times").to_pylist()):
            at, times = np.cumsum(np.frombuffer(p, "<i4")), np.frombuffer(t, "<i4").astype(np.int64)
            sums.append(int((times * n[at]).sum()))
            tops.append(int(times[best[at]].sum()))
        return pa.table({**{c: left.column(c) for c in names}, "n_best": pa.array(tops, pa.int64()),
                         "count_sum": pa.array(sums, pa.int64()), "groups": left.column("groups")})

    return (found.drop("keys", "held").groupBy("block").cogroup(told.groupBy("of"))
            .applyInArrow(weigh, f"doc_id {kind}, " + ", ".join(f"{c} bigint" for c in [*names[1:], "n_best", "count_sum"]) + ", groups string"))
