"""Token counts from distinct pre-tokens.

1. Every task cuts its documents' texts into pre-tokens and packs them by chunk:
   the documents' pre-token frequencies stay with the chunk as a sparse matrix of
   numbers, the chunk's distinct pre-tokens travel, sorted and compressed, one
   packed row per hash bucket.
2. A bucket counts the pieces of each distinct pre-token once, whichever chunks
   it came from, and answers each chunk with an array of counts.
3. Counts meet the frequencies by chunk, and a matrix product sums them per
   document.  No token id is ever stored.

A frequent pre-token costs one entry per chunk, never one per document, and a
bucket's size follows from its number, which grows with the text.

Defined results: a null or empty text has 0 bytes and 0 tokens; repeated rows
are counted alike; special strings inside a text count as one token, as the
library's default has it; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidyframe.llm.common import materialize, slices, utf8

PAIRS = 2_000_000          # (document, pre-token) pairs of a chunk
BUCKET_BYTES = 16 << 20    # text bytes that a bucket answers for
_tokenizers: dict = {}


def _tokenizer(path: str):
    if path not in _tokenizers:
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        specials = [a.content for a in t.get_added_tokens_decoder().values()]
        _tokenizers[path] = t, re.compile("(" + "|".join(map(re.escape, specials)) + ")")
    return _tokenizers[path]


def _cutter(path: str):
    """word (bytes without ASCII white space) -> its pre-tokens as strings; a special
    string is marked by a leading NUL."""
    t, special = _tokenizer(path)
    normal, pre = t.normalizer, t.pre_tokenizer

    def cut(word: bytes) -> list[str]:
        # two plain cases first: ASCII letters alone, or before one full stop or comma
        if word.isalpha() and word.isascii():
            return [word.lower().decode()]
        if word[-1:] in (b".", b",") and word[:-1].isalpha() and word.isascii():
            return [word[:-1].lower().decode(), word[-1:].decode()]
        text = word.decode("utf-8", "replace")
        out = []
        for k, part in enumerate(special.split(text) if special.pattern != "()" else [text]):
            if k % 2:
                out.append("\0" + part)
            elif part:
                out += [p for p, _ in pre.pre_tokenize_str(normal.normalize_str(part))]
        return out

    return cut


def _pack(path: str, buckets: int):
    def run(batches):
        import pyarrow as pa
        import xxhash
        import zstandard
        from pyspark import TaskContext

        squeeze = zstandard.ZstdCompressor(level=3).compress
        cut, known, task = _cutter(path), {}, TaskContext.get().partitionId()
        names = ["chunk", "bucket", "docs", "payload"]

        def rows(no, doc_rows, index, lens, nums, freqs):
            chunk = (task << 32) + no
            words = sorted(index)
            place = np.empty(len(words), dtype=np.int64)
            home = np.fromiter((xxhash.xxh3_64_intdigest(w.encode()) % buckets for w in words),
                               dtype=np.int64, count=len(words))
            order = np.argsort(home, kind="stable")
            # pre-token numbers follow (bucket, string): the order of the answers
            place[np.fromiter((index[words[k]] for k in order), dtype=np.int64, count=len(order))] = \
                np.arange(len(order))
            blob = squeeze(b"".join([
                np.array([len(doc_rows), len(nums)], dtype=np.int64).tobytes(),
                np.array(lens, dtype=np.int32).tobytes(),
                place[np.array(nums, dtype=np.int64)].astype(np.int32).tobytes(),
                np.array(freqs, dtype=np.int32).tobytes()]))
            out = [(chunk, None, doc_rows, blob)]
            cuts = np.flatnonzero(np.diff(home[order])) + 1
            for own in np.split(order, cuts) if len(order) else []:
                out.append((chunk, int(home[own[0]]), None,
                            squeeze("\n".join(words[k] for k in own).encode())))
            return pa.RecordBatch.from_arrays([
                pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int64()),
                pa.array([r[2] for r in out], doc_type), pa.array([r[3] for r in out], pa.binary())],
                names=names)

        doc_type = None
        no, state = 0, ([], {}, [], [], [])
        for part in slices(batches):
            if doc_type is None:
                doc_type = pa.list_(pa.struct([("doc_id", part.schema.field("doc_id").type),
                                               ("n_bytes", pa.int64())]))
            for doc_id, text in zip(part.column("doc_id").to_pylist(),
                                    part.column("text").to_pylist(), strict=True):
                doc_rows, index, lens, nums, freqs = state
                raw = utf8(text)
                own: dict[str, int] = {}
                for w in raw.split():
                    ps = known.get(w)
                    if ps is None:
                        ps = cut(w)
                        if len(w) < 200:
                            if len(known) > 200_000:
                                known.clear()
                            known[w] = ps
                    for p in ps:
                        own[p] = own.get(p, 0) + 1
                doc_rows.append({"doc_id": doc_id, "n_bytes": len(raw)})
                lens.append(len(own))
                nums += [index.setdefault(p, len(index)) for p in own]
                freqs += own.values()
                if len(nums) >= PAIRS:
                    yield rows(no, *state)
                    no, state = no + 1, ([], {}, [], [], [])
        if state[0]:
            yield rows(no, *state)

    return run


def _count(path: str):
    def run(table):
        import pyarrow as pa
        import zstandard

        t, _ = _tokenizer(path)
        open_, squeeze, pieces = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor().compress, {}
        size = t.model.tokenize
        answers = []
        for payload in table.column("payload"):
            words = open_.decompress(payload.as_buffer()).decode().split("\n")
            for w in words:
                if w not in pieces:
                    pieces[w] = 1 if w[:1] == "\0" else len(size(w))
            answers.append(squeeze(np.fromiter((pieces[w] for w in words), dtype=np.int32,
                                               count=len(words)).tobytes()))
        return pa.table([table.column("chunk"), table.column("bucket"), pa.array(answers, pa.binary())],
                        names=["chunk", "bucket", "counts"])

    return run


def _sum(left, right):
    import pyarrow as pa
    import zstandard

    unzip = zstandard.ZstdDecompressor().decompress
    order = np.argsort(np.asarray(right.column("bucket")))
    counts = [np.frombuffer(unzip(right.column("counts")[int(k)].as_buffer()), dtype=np.int32)
              for k in order]
    counts = np.concatenate([*counts, np.empty(0, np.int32)]).astype(np.int64)
    docs = pa.concat_arrays(left.column("docs").chunks).flatten()
    blob = unzip(left.column("payload")[0].as_buffer())
    n, m = np.frombuffer(blob, np.int64, 2)
    lens = np.frombuffer(blob, np.int32, n, 16)
    nums = np.frombuffer(blob, np.int32, m, 16 + 4 * n)
    freqs = np.frombuffer(blob, np.int32, m, 16 + 4 * n + 4 * m)
    ends = np.concatenate([[0], np.cumsum(counts[nums] * freqs)])
    at = np.concatenate([[0], np.cumsum(lens)])
    return pa.table([docs.field("doc_id"), docs.field("n_bytes"),
                     pa.array(ends[at[1:]] - ends[at[:-1]], pa.int64())],
                    names=["doc_id", "n_bytes", "n_tokens"])


def count_tokens(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """``docs(doc_id, text)`` -> doc_id, n_bytes, n_tokens of every row.
    ``tokenizer_path``: a ``tokenizers`` JSON file that every executor can open."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    n_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, n_bytes // BUCKET_BYTES)
    doc_type = f"array<struct<doc_id:{id_type},n_bytes:bigint>>"
    packed = materialize(docs.select("doc_id", "text").mapInArrow(
        _pack(tokenizer_path, buckets),
        f"chunk long, bucket long, docs {doc_type}, payload binary"), "token-chunks")
    vocabulary = packed.filter("bucket IS NOT NULL").select("chunk", "bucket", "payload")
    counts = vocabulary.groupBy("bucket").applyInArrow(
        _count(tokenizer_path), "chunk long, bucket long, counts binary")
    chunks = packed.filter("bucket IS NULL").select("chunk", "docs", "payload")
    return chunks.groupBy("chunk").cogroup(counts.groupBy("chunk")).applyInArrow(
        _sum, f"doc_id {id_type}, n_bytes long, n_tokens long")
