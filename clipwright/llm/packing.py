"""Problem 8: texts of varying length put into containers of a fixed token capacity.

Texts are tokenised whole in Arrow batches; one longer than the capacity is cut into pieces of it.
Pieces, without their text, are dealt into random groups of bounded size (by their row, so null and
repeated ids are dealt like any other), and each group is packed
first-fit decreasing with a tournament tree over the remaining room of its containers: the first
container with enough room is found in logarithmic time. A group's last containers are the only
room lost to grouping, and that share shrinks with the group size.

Defined results
  null or empty text   -> one piece of 0 tokens, which goes where it fits
  text over capacity   -> full pieces and a rest, in order; no other text is cut
  equal sizes          -> by smaller (id, piece)
  repeated rows        -> each is packed
  empty table          -> empty result
Extra columns are ignored.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut, spread

CAPACITY, GROUP = 2048, 20_000
TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"


def token_counts(df: DataFrame, ident: str, text: str, tokenizer: str = TOKENIZER) -> DataFrame:
    """(id, tokens) of every row, by a public tokenizer; its file, which the driver can read at ``tokenizer``, is sent to the executors."""
    df.sparkSession.sparkContext.addFile(tokenizer)
    name = os.path.basename(tokenizer)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece
        from pyspark import SparkFiles

        sp = sentencepiece.SentencePieceProcessor(model_file=SparkFiles.get(name))
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            n = [len(sp.encode(t)) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64())], names=["id", "tokens"])

    kind = df.select(ident).schema[0].dataType.simpleString()
    return df.select(F.col(ident).alias("id"), F.col(text).alias("text")).mapInArrow(count, f"id {kind}, tokens bigint")


def pieces_of(sizes: DataFrame, capacity: int) -> DataFrame:
    """(id, piece, tokens): one piece per text, more only where it exceeds the capacity."""
    last = F.greatest(F.ceil(F.col("tokens") / capacity).cast("int") - 1, F.lit(0))
    cutup = sizes.select("id", "tokens", F.explode(F.sequence(F.lit(0), last)).alias("piece"))
    return cutup.select("id", "piece", F.least(F.col("tokens") - F.col("piece").cast("bigint") * capacity, F.lit(capacity).cast("bigint")).alias("tokens"))


class Tournament:
    """First-fit over containers: a complete binary tree whose nodes hold the most room below them."""

    def __init__(self, n: int, capacity: int):
        self.leaves = 1 << max(0, (n - 1).bit_length())
        self.room = [capacity] * (2 * self.leaves)

    def put(self, size: int) -> int:
        """Place an item in the first container with room for it; the container's number."""
        room, at = self.room, 1
        while at < self.leaves:
            at *= 2
            if room[at] < size:
                at += 1
        slot = at - self.leaves
        room[at] -= size
        while at > 1:
            at //= 2
            best = max(room[2 * at], room[2 * at + 1])
            if room[at] == best:
                break
            room[at] = best
        return slot


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """The container of each item; items are taken in the given order among equal sizes."""
    tree = Tournament(max(1, len(sizes)), capacity)
    out = [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        out[i] = tree.put(sizes[i])
    return out


def pack(pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """(id, piece, tokens, container) for pieces (id, piece, tokens) of at most ``capacity``."""
    pieces = cut(pieces)
    groups = max(1, -(-pieces.count() // group))
    # The written table fixes its rows' places, so a repeated task deals the same way.
    dealt = pieces.withColumn("g", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come sorted by group; a group has about ``group`` rows, whatever the table's size.
        held: list[tuple] = []

        def flush():
            bins = first_fit_decreasing([r[3] for r in held], capacity)
            cols = list(zip(*((r[1], r[2], r[3], (r[0] << 32) + b) for r, b in zip(held, bins))))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["id", "piece", "tokens", "container"])

        types = None
        for batch in batches:
            types = [batch.schema.field(1).type, pa.int32(), pa.int64(), pa.int64()]
            for row in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if held and held[0][0] != row[0]:
                    yield flush()
                    held = []
                held.append(row)
        if held:
            yield flush()

    kind = pieces.schema["id"].dataType.simpleString()
    ordered = dealt.select("g", "id", "piece", "tokens").repartition("g").sortWithinPartitions("g", "id", "piece")
    return ordered.mapInArrow(packed, f"id {kind}, piece int, tokens bigint, container bigint")


def p8_containers(spark: SparkSession, sf_dir: str, capacity: int = CAPACITY, tokenizer: str = TOKENIZER) -> DataFrame:
    """A container number for every text or piece of an over-long text."""
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    out = pack(pieces_of(token_counts(docs, "doc_id", "text", tokenizer), capacity), capacity)
    return out.select(F.col("id").alias("doc_id"), "piece", "tokens", "container")


def p8_room(spark: SparkSession, sf_dir: str, capacity: int = CAPACITY) -> DataFrame:
    """How the containers turned out: texts placed, tokens lost or doubled by cutting, containers over capacity, and whether 99 % of the room of a whole group is used."""
    placed = cut(p8_containers(spark, sf_dir, capacity))
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    wanted = token_counts(docs, "doc_id", "text").agg(F.sum("tokens").alias("wanted"))
    bins = placed.groupBy("container").agg(F.sum("tokens").alias("held"))
    # A group's last container may stay as empty as it likes: one container a group is the room grouping may lose.
    room = bins.agg(F.count_if(F.col("held") > capacity).alias("over_full"), F.sum("held").alias("held"), F.count("*").alias("bins"), F.count_distinct(F.shiftright("container", 32)).alias("groups"))
    texts = placed.agg(F.count_distinct("doc_id").alias("texts"))
    full = F.coalesce(F.col("held") >= 0.99 * capacity * (F.col("bins") - F.col("groups")), F.lit(True))
    return texts.crossJoin(room).crossJoin(wanted).select("texts", "over_full", F.coalesce(F.col("held") - F.col("wanted"), F.lit(0)).alias("tokens_astray"), full.alias("well_filled"))
