"""Operator 10, packing by the sum-of-squares rule.

A document's full windows are cut off first. Its rest goes into an open window of
the level (tokens filled) that makes the sum of the squared numbers of open windows
by level smallest; an array holds these numbers and one comparison over the array
finds the level. Each task packs the rows of its own input split and at its end
pours the emptiest open windows into the fullest, so at most one window of a task
is padded.
"""

from __future__ import annotations

import os
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annolake.llm.common import CACHE_ENTRIES, CACHE_WORD, small_batches, texts_of

WINDOW = 4096
END_ID = 2
TOKENIZER = "word_bpe_49k.json"
BLOCK_BYTES = 8 << 20     # texts whose ids are looked up together


# Texts of these characters (ASCII without apostrophe and "<", Latin-1 letters) are split here as the tokenizer's own
# pattern splits them: runs of letters, single digits, runs of the rest, white space dropped. In other texts each word
# goes through the tokenizer.
_PLAIN = re.compile("[\x20\x09-\x0D!-&(-;=-~À-ÖØ-öø-ÿ]*")
_APART = "([^\x20\x09-\x0Da-zß-öø-ÿ0-9]+|[0-9])"


class Ids:
    """Texts to little-endian uint32 ids.

    The tokenizer drops white space, so a text's ids are those of its words one after the other, and a plain
    word's ids are those of its parts, which the tokenizer's model gives. The texts of a block are
    taken apart together, each distinct part is looked up once, and the ids are gathered by array operations."""

    def __init__(self, path: str | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        if path is None:
            import public_tokenizers
            path = public_tokenizers.path(TOKENIZER)
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        spell = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.letters = {k: spell(chr(k))[0][0] for k in range(0xC0, 0x100)}   # how the model spells a letter's bytes
        self.words: dict[bytes, bytes] = {}

    def block(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text."""
        out: list[bytes] = [b""] * len(texts)
        at, plain = [], []
        for k, t in enumerate(texts):
            s = t.decode()
            if _PLAIN.fullmatch(s):
                at.append(k)
                plain.append(s.lower())
            else:
                out[k] = b"".join(map(self.word, t.split()))
        if plain:
            spaced = pc.replace_substring_regex(pa.array(plain, pa.large_string()), _APART, r" \1 ")
            split = pc.ascii_split_whitespace(spaced)
            parts = split.flatten()
            bounds = np.zeros(len(plain) + 1, np.int64)
            coded = parts.dictionary_encode()
            idx = coded.indices.to_numpy(zero_copy_only=False)
            ids, n = [], []
            for p in coded.dictionary.to_pylist():
                got = self.part(p) if p else []
                ids += got
                n.append(len(got))
            flat, n = np.array(ids, "<u4"), np.array(n, np.int64)
            first = np.cumsum(n) - n
            size = n[idx] if len(idx) else np.zeros(0, np.int64)
            upto = np.concatenate([[0], np.cumsum(size)])
            gather = np.arange(upto[-1]) + np.repeat(first[idx] - upto[:-1], size) if len(idx) else np.zeros(0, np.int64)
            raw = flat[gather].tobytes()
            bounds[1:] = np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))
            cut = (4 * upto[bounds]).tolist()
            for k, a, b in zip(at, cut, cut[1:]):
                out[k] = raw[a:b]
        return out

    def part(self, part: str) -> list[int]:
        return [t.id for t in self.model.tokenize(part if part.isascii() else part.translate(self.letters))]

    def word(self, word: bytes) -> bytes:
        got = self.words.get(word)
        if got is None:
            got = np.array(self.tokenizer.encode(word.decode(), add_special_tokens=False).ids, "<u4").tobytes()
            if len(word) <= CACHE_WORD:
                if len(self.words) >= CACHE_ENTRIES:
                    self.words.clear()
                self.words[word] = got
        return got

    def __call__(self, text: bytes) -> bytes:
        return self.block([text])[0]


class Packer:
    """The windows of one task. ``ready`` collects (document, start, ids, doc_tokens, sequence, offset)."""

    def __init__(self, window: int, first: int):
        self.window, self.next = window, first
        self.counts = np.zeros(window + 1, np.int64)          # open windows by level
        self.open: dict[int, list[tuple[int, list]]] = {}     # level -> (sequence, pieces)
        self.ready: list[tuple] = []

    def add(self, doc, ids: bytes) -> None:
        n, w = len(ids) // 4, self.window
        for s in range(0, n - w + 1, w):
            self.ready.append((doc, s, ids[4 * s:4 * (s + w)], n, self.next, 0))
            self.next += 1
        rest = n % w
        if rest:
            self.place(rest, (doc, n - rest, ids[4 * (n - rest):], n))

    def place(self, size: int, piece: tuple) -> None:
        n, w = self.counts, self.window
        # change of the sum of squares when a window of level g goes to level g + size, g = 1 .. w - size
        cost = 2 * (n[size + 1:w + 1] - n[1:w - size + 1]) + 2
        cost[-1:] = 1 - 2 * n[w - size]                       # a full window is no longer counted
        cost[n[1:w - size + 1] == 0] = np.iinfo(np.int64).max
        level = 0
        if len(cost):
            k = len(cost) - 1 - int(np.argmin(cost[::-1]))    # ties: the fullest level
            if cost[k] <= 2 * n[size] + 1:
                level = k + 1
        if level:
            seq, pieces = self.open[level].pop()
            n[level] -= 1
        else:
            seq, pieces = self.next, []
            self.next += 1
        pieces.append((*piece, level))
        if level + size == w:
            self.close(seq, pieces)
        else:
            n[level + size] += 1
            self.open.setdefault(level + size, []).append((seq, pieces))

    def close(self, seq: int, pieces: list) -> None:
        self.ready += [(doc, start, ids, n, seq, at) for doc, start, ids, n, at in pieces]

    def finish(self) -> None:
        """Pour the emptiest open windows into the fullest; documents may be cut anywhere."""
        left = [(level, seq, pieces) for level in sorted(self.open, reverse=True) for seq, pieces in self.open[level]]
        lo, hi = 0, len(left) - 1
        while lo < hi:
            level, seq, pieces = left[lo]
            level2, seq2, pieces2 = left[hi]
            doc, start, ids, n, at = pieces2[-1]
            size = len(ids) // 4
            take = min(size, self.window - level)
            cut = 4 * (size - take)
            pieces.append((doc, start + size - take, ids[cut:], n, level))
            level, level2 = level + take, level2 - take
            if take == size:
                pieces2.pop()
            else:
                pieces2[-1] = (doc, start, ids[:cut], n, at)
            left[lo], left[hi] = (level, seq, pieces), (level2, seq2, pieces2)
            if level == self.window:
                self.close(seq, pieces)
                lo += 1
            if level2 == 0:
                hi -= 1
        for _, seq, pieces in left[lo:hi + 1]:
            if pieces:
                self.close(seq, pieces)


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW,
         tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]), one row for each piece.

    Each row of ``docs`` is a document of its own, repeated rows and null ids too. Null or
    empty text: one piece with the end id alone. ``sequence_id`` is the number of the
    input split times 2^32 plus a running number. Empty table: empty result.
    Other columns are not read.
    """
    spark = docs.sparkSession
    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    small_batches(spark)
    kind = d.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", kind), *[T.StructField(n, T.LongType()) for n in (
        "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")],
        *([T.StructField("ids", T.BinaryType())] if with_ids else [])])
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches):
        from pyspark import TaskContext

        to_ids, packer, kind = Ids(tokenizer), Packer(window, TaskContext.get().partitionId() << 32), None

        def rows():
            r, packer.ready = packer.ready, []
            cols = [pa.array([x[0] for x in r], kind)]
            cols += [pa.array(c, pa.int64()) for c in (
                [x[1] for x in r], [len(x[2]) // 4 for x in r], [zlib.crc32(x[2]) for x in r],
                [x[3] for x in r], [x[4] for x in r], [x[5] for x in r])]
            if with_ids:
                cols.append(pa.array([x[2] for x in r], pa.binary()))
            return pa.RecordBatch.from_arrays(cols, names=schema.names)

        docs_, texts, size = [], [], 0
        for b in batches:
            kind = b.schema.field("doc_id").type
            for doc, t in zip(b.column(0).to_pylist(), texts_of(b, "text")):
                docs_.append(doc)
                texts.append(t)
                size += len(t)
                if size >= BLOCK_BYTES:
                    for x, ids in zip(docs_, to_ids.block(texts)):
                        packer.add(x, ids + end)
                    docs_, texts, size = [], [], 0
                    yield rows()
        for x, ids in zip(docs_, to_ids.block(texts)):
            packer.add(x, ids + end)
        packer.finish()
        if packer.ready:
            yield rows()

    return d.mapInArrow(run, schema)
