"""How quality filters interact, over a sparse document-term matrix.

Words are dictionary-encoded twice. A task encodes the words of its documents with a dictionary of its own and writes compressed
sparse rows (CSR) over it, in blocks; only the distinct words of a task go on. They meet in the parts of one dictionary (by a hash of the word),
which gives every word of the corpus a number of its own, and each task's blocks meet the numbers of its words again: the shards of
one matrix, with global columns. A common word comes once from each shard, so no word is hot. Words and numbers move as packed bytes, a row for each shard and
part.

Row sums of the matrix are counts of words, and the numbers of nonzero entries are counts of distinct ones. With flags that the
first pass took from the texts, and the smallest id among equal texts, each document has the set of the filters that it
fails; the documents of a part with one set are one row from then on, and every order of the filters is answered from these.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from flowlab.llm.common import bounded_batches, frugal, stage
from flowlab.llm.skew import join_weighted

#: A shard ends at the first batch after which it has so many words, or bytes of text.
SHARD_WORDS, SHARD_BYTES = 1_000_000, 128 << 20
#: Parts of the dictionary: so many for each shuffle partition, between a least and a most. A part is held by one task at a time.
PARTS, LEAST_PARTS, MOST_PARTS = 4, 16, 4096
#: The filters' parameters.
FEWEST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, SYMBOLS = 100, 80, 10, "#$%&*|"
FILTERS = "ABCDE"

_B = np.arange(256)
_CAPITAL = (_B >= 65) & (_B <= 90)
_BEGINS = (_B & 0xC0) != 0x80  # the first byte of a character
_SYMBOL = np.isin(_B, [ord(c) for c in SYMBOLS])


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, where texts begin and end in them) of a string array without nulls."""
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1]
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), at


def _sparse_rows(texts: pa.Array, vocabulary: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(indptr, indices, data) of the texts' words; words that the vocabulary lacks get the next numbers in it. Words lie between ASCII white space."""
    lists = pc.ascii_split_whitespace(texts)
    row = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
    words = lists.flatten()
    some = pc.greater(pc.binary_length(words), 0)  # white space at an end leaves an empty word
    row, words = row[some.to_numpy(zero_copy_only=False)], words.filter(some)
    coded = words.dictionary_encode()
    number = np.fromiter((vocabulary.setdefault(w, len(vocabulary)) for w in coded.dictionary.cast(pa.binary()).to_pylist()), np.int64, len(coded.dictionary))
    entry = row * np.int64(max(len(vocabulary), 1)) + number[coded.indices.to_numpy()]
    entry, data = np.unique(entry, return_counts=True)
    row, indices = np.divmod(entry, max(len(vocabulary), 1))
    return np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(texts)))]).astype(np.int64), indices.astype(np.int32), data.astype(np.int32)


_DOCUMENT = "part:string,capitals:bigint,chars:bigint,symbol:boolean,address:binary"
_BLOCK = "indptr binary, indices binary, data binary"


def _scanned(docs: DataFrame, key: str, text: str, part: str, parts: int) -> DataFrame:
    """The first pass: blocks (kind 1) with documents, indptr, indices, data; and the words of each shard (kind 0), joined by line feeds, with their
    numbers in the shard, in a row for each part of the dictionary."""
    bounded_batches(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    ddl = f"shard bigint, kind int, block int, documents array<struct<key:{kind},{_DOCUMENT}>>, {_BLOCK}, dictionary int, words binary, numbers binary"
    schema = to_arrow_schema(docs.sparkSession.createDataFrame([], ddl).schema)

    def batch_of(row: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([row[f.name] if isinstance(row.get(f.name), pa.Array) else pa.array([row.get(f.name)], f.type) for f in schema], schema=schema)

    @frugal
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 32
        vocabulary, block, size = {}, 0, 0

        def words() -> Iterator[pa.RecordBatch]:
            own = list(vocabulary)
            of = np.fromiter((crc32(w) % parts for w in own), np.int64, len(own))
            order = np.argsort(of, kind="stable")
            ends = np.searchsorted(of[order], np.arange(parts + 1))
            for p in range(parts):
                at = order[ends[p] : ends[p + 1]]
                if len(at):
                    yield batch_of({"shard": shard, "kind": 0, "dictionary": p, "words": b"\n".join([own[i] for i in at]), "numbers": at.astype("<i4").tobytes()})

        for batch in batches:
            if not batch.num_rows:
                continue
            texts = pc.fill_null(batch[1], "")
            data, at = _bytes_of(texts)
            flags = [np.array([np.count_nonzero(m[a:b]) for a, b in zip(at, at[1:], strict=False)], np.int64) for m in (_CAPITAL[data], _BEGINS[data], _SYMBOL[data])]
            address = [hashlib.blake2b(data[a:b], digest_size=16).digest() for a, b in zip(at, at[1:], strict=False)]
            indptr, indices, counts = _sparse_rows(texts, vocabulary)
            members = [batch[0], pc.fill_null(batch[2], ""), pa.array(flags[0]), pa.array(flags[1]), pa.array(flags[2] > 0), pa.array(address, pa.binary())]
            documents = pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), pa.StructArray.from_arrays(members, fields=list(schema.field("documents").type.value_type)))
            yield batch_of({"shard": shard, "kind": 1, "block": block, "documents": documents, "indptr": indptr.tobytes(), "indices": indices.tobytes(), "data": counts.tobytes()})
            block, size = block + 1, size + len(data)
            if len(vocabulary) >= SHARD_WORDS or size >= SHARD_BYTES:
                yield from words()
                shard, vocabulary, block, size = shard + 1, {}, 0, 0
        yield from words()

    return docs.select(F.col(f"`{key}`"), F.col(f"`{text}`"), F.col(f"`{part}`").cast("string")).mapInArrow(scan, ddl)


def _numbered(scanned: DataFrame, parts: int, new_words: bool) -> DataFrame:
    """(shard, numbers, word_ids) for each shard and part of the dictionary; with new_words the dictionary (word, word_id) itself. A part's words are met in
    the order of shards, so a task that runs again gives the same numbers."""
    rows = scanned.filter("kind = 0").select("dictionary", "shard", "words", "numbers").repartition("dictionary").sortWithinPartitions("dictionary", "shard")
    ddl = "word string, word_id bigint" if new_words else "shard bigint, numbers binary, word_ids binary"
    schema = to_arrow_schema(scanned.sparkSession.createDataFrame([], ddl).schema)

    @frugal
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, known = None, {}
        for batch in batches:
            for i, p in enumerate(batch["dictionary"].to_pylist()):
                if p != part:
                    part, known = p, {}
                before, words = len(known), batch["words"][i].as_py().split(b"\n")
                ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words)) * parts + p
                if new_words:
                    fresh = {w: n for w, n in zip(words, ids.tolist(), strict=True) if n >= before * parts}
                    yield pa.RecordBatch.from_arrays([pa.array(list(fresh), pa.binary()).cast(pa.string()), pa.array(list(fresh.values()), pa.int64())], schema=schema)
                else:
                    yield pa.RecordBatch.from_arrays([batch["shard"].slice(i, 1), batch["numbers"].slice(i, 1), pa.array([ids.astype("<i8").tobytes()], pa.binary())], schema=schema)

    return rows.mapInArrow(number, ddl)


def document_term_matrix(docs: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> tuple[DataFrame, DataFrame]:
    """(matrix, dictionary). matrix: a row for each block of documents: shard, block, documents (an array with the key, part, capitals, chars,
    symbol, address of each) and their words as CSR, little-endian: indptr (int64), indices (int64, word_id) and data (int32, how often).
    dictionary: word, word_id (unique; its parts are numbered in turn, so there are few gaps).

    Words are maximal runs without ASCII white space, case-sensitive. Null texts are empty; a text without a word is an empty row. Repeated rows
    and null keys are rows of their own; a null part is the empty string. Other columns are not carried. An empty table has no blocks. A text of any
    length is one row; it is the only thing that makes a block or a shard larger than the constants say."""
    parts = min(MOST_PARTS, max(LEAST_PARTS, PARTS * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    scanned = stage(_scanned(docs, key, text, part, parts), "shards")
    blocks = scanned.filter("kind = 1").select("shard", "block", "documents", "indptr", "indices", "data")
    # the numbers of a shard's words, then its blocks
    both = _numbered(scanned, parts, False).withColumn("at", F.col("shard") * 2).drop("shard").unionByName(blocks.withColumn("at", F.col("shard") * 2 + 1), allowMissingColumns=True)
    both = both.repartition(F.shiftright("at", 1)).sortWithinPartitions("at")
    ddl = ", ".join(f"{c} {blocks.schema[c].dataType.simpleString()}" for c in blocks.columns)
    schema = to_arrow_schema(docs.sparkSession.createDataFrame([], ddl).schema)

    @frugal
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, met, number = None, [], None
        for batch in batches:
            for i, at in enumerate(batch["at"].to_pylist()):
                if at >> 1 != shard:
                    shard, met, number = at >> 1, [], None
                if at % 2 == 0:
                    met.append((np.frombuffer(batch["numbers"][i].as_py(), "<i4"), np.frombuffer(batch["word_ids"][i].as_py(), "<i8")))
                    continue
                if number is None:
                    number = np.zeros(sum(len(x) for x, _ in met), np.int64)
                    for local, word_id in met:
                        number[local] = word_id
                    met = []
                glob = number[np.frombuffer(batch["indices"][i].as_py(), np.int32)].astype("<i8")
                yield pa.RecordBatch.from_arrays([pa.array([glob.tobytes()], pa.binary()) if f.name == "indices" else batch[f.name].slice(i, 1) for f in schema], schema=schema)

    return both.mapInArrow(encode, ddl), _numbered(scanned, parts, True)


def row_statistics(matrix: DataFrame) -> DataFrame:
    """A row for each document of a `document_term_matrix`: key, part, capitals, chars, symbol, address, words (the row's sum) and distinct (its nonzero entries)."""
    members = matrix.schema["documents"].dataType.elementType
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in members) + ", words bigint, distinct bigint"
    schema = to_arrow_schema(matrix.sparkSession.createDataFrame([], ddl).schema)

    @frugal
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                documents = batch["documents"][i].values
                indptr, data = np.frombuffer(batch["indptr"][i].as_py(), np.int64), np.frombuffer(batch["data"][i].as_py(), np.int32)
                total = np.concatenate([[0], np.cumsum(data, dtype=np.int64)])[indptr]
                yield pa.RecordBatch.from_arrays([*documents.flatten(), pa.array(np.diff(total)), pa.array(np.diff(indptr))], schema=schema)

    return matrix.select("documents", "indptr", "data").mapInArrow(sums, ddl)


def failing(docs: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """key, part and fails (the letters of the filters that a document fails, in order) for every document.

    A: under FEWEST_WORDS words. B: under LEAST_DISTINCT % of them distinct. C: over MOST_CAPITALS % of the code points are `[A-Z]`. D: one of SYMBOLS
    occurs. E: an equal text has a smaller key; rows with one key and text are not copies of each other, and a null key neither is
    smaller than another nor has a smaller one. Null texts are empty."""
    matrix, _ = document_term_matrix(docs, key, text, part)
    rows = stage(row_statistics(matrix), "rows")
    same = rows.groupBy(F.col("address").alias("s_address")).agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("least"))
    same = stage(same.filter("n > 1"), "copies")
    met = join_weighted(rows, same, F.col("address") == F.col("s_address"), "n", "left")
    tests = {
        "A": F.col("words") < FEWEST_WORDS,
        "B": 100 * F.col("distinct") < LEAST_DISTINCT * F.col("words"),
        "C": 100 * F.col("capitals") > MOST_CAPITALS * F.col("chars"),
        "D": F.col("symbol"),
        "E": F.col("key") > F.col("least"),
    }
    return met.select("key", "part", F.concat(*[F.when(t, F.lit(c)).otherwise(F.lit("")) for c, t in tests.items()]).alias("fails"))


def audit(fails: DataFrame, labels: DataFrame) -> DataFrame:
    """A row for each part, order of the filters (filter_order) and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    fails: as `failing` gives it. labels: doc_id, quality, toxic; a document counts as good (toxic) if one of its rows says 1, and as neither without
    a row. No fails give no rows; every part has a row for each order and step, zeros included."""
    said = labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("l_doc")).agg(F.max(F.when(F.col("quality") == 1, 1)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1)).alias("toxic"))
    met = fails.join(said, F.col("key") == F.col("l_doc"), "left")
    # at most 32 rows for a part
    cells = met.groupBy("part", "fails").agg(F.count(F.lit(1)).alias("n"), F.count("good").alias("n_good"), F.count("toxic").alias("n_toxic"))
    orders = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])
    steps = cells.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    steps = steps.withColumn("letter", F.expr("substring(filter_order, step, 1)")).withColumn("before", F.expr("substring(filter_order, 1, step - 1)"))
    fails_it = F.expr("instr(fails, letter) > 0")
    gone = F.expr("translate(before, fails, '') <> before")
    removed = fails_it & ~gone
    of = lambda n, when: F.sum(F.when(when, F.col(n)).otherwise(0)).cast("bigint")
    return steps.groupBy("part", "filter_order", "step").agg(
        of("n", ~fails_it & ~gone).alias("kept"), of("n", removed).alias("removed"), of("n", fails_it & gone).alias("redundant"),
        of("n", F.col("fails") == F.col("letter")).alias("unique_fails"), of("n_good", removed).alias("good_lost"), of("n_toxic", removed).alias("toxic_lost"),
        # of the filters that a document fails each comes first in as many orders as another
        F.sum(F.when(fails_it, F.expr("n * (120 div greatest(length(fails), 1))")).otherwise(0)).cast("bigint").alias("shapley"),
    )
