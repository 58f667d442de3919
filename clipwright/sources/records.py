"""Records of one CSV file, read by as many tasks as the file has splits.

Whether a line end closes a record depends on the quotes of all lines before it. So each split is surveyed under both
beginnings, outside quotes and inside them; what the first split ends with tells how the second begins, and so on. The
second pass then parses every split on its own, and only records that lie over an edge are put together afterwards.

A quote opens a field only where the field begins; elsewhere in a plain field it is a character. Two quotes inside a
quoted field are one; what follows the closing quote belongs to the field. Line breaks inside quotes are kept as they
are, a record ends with \\n or \\r\\n. Bytes that are no UTF-8 become replacement characters.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut

_QUOTED, _AFTER = rb'[^"]*+(?:""[^"]*+)*+', rb"[^,]*+"
_FIELD = rb'(?:"' + _QUOTED + rb'"' + _AFTER + rb'|[^",]' + _AFTER + rb")?+"
# A line that ends outside quotes, by whether it begins inside them.
_CLOSED = {False: re.compile(_FIELD + rb"(?:," + _FIELD + rb")*+"), True: re.compile(_QUOTED + rb'"' + _AFTER + rb"(?:," + _FIELD + rb")*+")}
_EACH = re.compile(rb',(?:"(' + _QUOTED + rb')"(' + _AFTER + rb')|([^",]' + _AFTER + rb"))?+")


def split_fields(record: bytes) -> list[bytes]:
    if b'"' not in record:
        return record.split(b",")
    return [plain or quoted.replace(b'""', b'"') + rest for quoted, rest, plain in _EACH.findall(b"," + record)]


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, block): lines without their \\n, and where in the file their split begins."""
    return spark.read.text(path, lineSep="\n").select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_block_start").alias("block"))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.Array, list[int]]]:
    """The lines of each block in a batch, and which of them have a quote; lines without one change nothing."""
    block = batch.column("block").to_numpy()
    at = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), len(block)]
    for s, e in zip(at, at[1:]):
        if s < e:
            lines = batch.column("value").slice(s, e - s)
            yield int(block[s]), lines, np.flatnonzero(pc.match_substring(lines, '"').to_numpy(zero_copy_only=False)).tolist()


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block and beginning: how many records end in it, and whether it ends inside quotes."""
    found: dict[tuple[int, bool], tuple[int, bool]] = {}
    for batch in batches:
        for block, lines, quoted in _runs(batch):
            have = [(i, lines[i].as_py()) for i in quoted]
            for begins in (False, True):
                n, inside = found.get((block, begins), (0, begins))
                pos = 0
                for i, line in have:
                    n += 0 if inside else i - pos
                    inside = not _CLOSED[inside].fullmatch(line)
                    n += not inside
                    pos = i + 1
                found[block, begins] = n + (0 if inside else len(lines) - pos), inside
    rows = [{"block": b, "begins": s, "records": n, "inside": i} for (b, s), (n, i) in found.items()]
    yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("block", pa.int64()), ("begins", pa.bool_()), ("records", pa.int64()), ("inside", pa.bool_())]))


def survey(lines: DataFrame) -> tuple[dict[int, tuple[int, bool]], int, bool]:
    """By block (records ended before it, whether it begins inside quotes), all records ended, whether the file ends inside quotes."""
    found = {(r["block"], r["begins"]): (r["records"], r["inside"]) for r in lines.mapInArrow(_survey, "block bigint, begins boolean, records bigint, inside boolean").collect()}
    starts, n, inside = {}, 0, False
    for block in sorted({b for b, _ in found}):
        starts[block] = (n, inside)
        more, inside = found[block, inside]
        n += more
    return starts, n, inside


def parse(lines: DataFrame, starts: dict[int, tuple[int, bool]], total: int, header: list[str], fields: list[str], is_bad: Callable[[dict[str, bytes]], bool]) -> DataFrame:
    """(fields, row_pos, bad) of the records 1 to ``total`` - 1; record 0 is the header. Written once, as a table.

    Short records are filled with '', longer ones than the header and blank lines are left out. A bad record keeps no fields.
    """
    at, width = [(f, header.index(f)) for f in fields], len(header)
    kinds = pa.schema([*((f, pa.string()) for f in fields), ("row_pos", pa.int64()), ("bad", pa.bool_()), ("block", pa.int64()), ("piece", pa.binary())])
    names = ", ".join([*(f"`{f}` string" for f in fields), "row_pos bigint, bad boolean, block bigint, piece binary"])

    def record(number: int, raw: bytes) -> Iterator[dict]:
        raw = raw.removesuffix(b"\r")
        have = split_fields(raw) if raw.strip(b" \t") else []
        if 0 < number < total and 0 < len(have) <= width:
            row = {f: have[i] if i < len(have) else b"" for f, i in at}
            bad = is_bad(row)
            yield {"row_pos": number, "bad": bad} | ({} if bad else {f: v.decode("utf-8", "replace") for f, v in row.items()})

    def piece(number: int, block: int, held: list[bytes]) -> Iterator[dict]:
        if 0 < number < total:
            yield {"row_pos": number, "block": block, "piece": b"\n".join(held)}

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, number, inside, headless, held = None, 0, False, False, []
        for batch in batches:
            rows: list[dict] = []
            for block, lines, quoted in _runs(batch):
                if block != now:
                    rows += piece(number, now, held) if held else ()
                    now, held, (number, inside) = block, [], starts[block]  # unknown only if the file was rewritten meanwhile, which is an error
                    headless = inside
                values, pos = lines.to_pylist(), 0
                for i in [*quoted, len(values)]:
                    if inside:
                        held += values[pos:i]
                    else:
                        for raw in values[pos:i]:
                            rows += record(number, raw)
                            number += 1
                    if i < len(values):
                        held.append(values[i])
                        inside = not _CLOSED[inside].fullmatch(values[i])
                        if not inside:
                            rows += piece(number, block, held) if headless else record(number, b"\n".join(held))
                            number, headless, held = number + 1, False, []
                    pos = i + 1
            yield pa.RecordBatch.from_pylist(rows, schema=kinds)
        if held:
            yield pa.RecordBatch.from_pylist([*piece(number, now, held)], schema=kinds)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, pieces in zip(batch.column("row_pos").to_pylist(), batch.column("pieces").to_pylist()):
                yield pa.RecordBatch.from_pylist([*record(number, b"\n".join(pieces))], schema=kinds)

    parsed = cut(lines.mapInArrow(each, names))
    out = parsed.where("piece IS NULL")
    if len(starts) > 1:
        over = parsed.where("piece IS NOT NULL").groupBy("row_pos").agg(F.transform(F.array_sort(F.collect_list(F.struct("block", "piece"))), lambda x: x["piece"]).alias("pieces"))
        out = out.unionByName(over.mapInArrow(joined, names))
    return out.select(*fields, "row_pos", "bad")
