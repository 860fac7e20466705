"""A streaming source whose offsets are blocks (SRC-8 offline, STR-1, STR-2, STR-4).

``format("blocks")`` follows chains over files of events. Its offset is the last block read of each chain, and the next one goes by
the chain's head, not by its events: as far as the head is deep enough (``confirmations``), and ``most`` blocks beyond the first new
one at most. So the cursor moves on a chain where nothing happens, and no event above it is ever read. A range of blocks is a
partition (``split`` blocks each), read on an executor with the range pushed into the files; its last row is a mark: no
transaction, and ``upto`` says that the range up to that block was read whole.

Options: ``path`` (events), ``heads`` (rows chain, head; the highest counts), ``cursors`` (rows chain, cursor: where a query without a
checkpoint begins), all folders of Parquet files; ``deploy`` (JSON: a chain's first block), ``confirmations``, ``most``, ``split``. A
folder that isn't there has no rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

COLUMNS = {"chain": pa.string(), "tx_hash": pa.string(), "log_index": pa.int32(), "block": pa.int64(), "event_name": pa.string(), "payload": pa.string()}
SCHEMA = "chain string, tx_hash string, log_index int, block long, event_name string, payload string, upto long"
#: Blocks beyond the first one that a batch may have. (A fixed value.)
MOST = 500


def files(path: str | None, columns: dict[str, pa.DataType]) -> ds.Dataset | None:
    """The files of a folder with the given columns, or None if it has none."""
    if not path:
        return None
    place, inner = fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)
    found = [f.path for f in place.get_file_info(fs.FileSelector(inner, allow_not_found=True, recursive=True)) if f.is_file and not f.base_name.startswith(("_", "."))]
    return ds.dataset(sorted(found), format="parquet", filesystem=place, schema=pa.schema(list(columns.items()))) if found else None


class BlockRange(InputPartition):
    def __init__(self, chain: str, first: int, last: int):
        self.chain, self.first, self.last = chain, first, last


class BlockReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.options = dict(options)
        self.confirmations, self.most, self.split = (int(options.get(k, d)) for k, d in (("confirmations", 0), ("most", MOST), ("split", MOST)))
        self.deploy: dict[str, int] = json.loads(options.get("deploy", "{}"))
        self.at = self._highest("cursors", "cursor")

    def _highest(self, option: str, column: str) -> dict[str, int]:
        found = files(self.options.get(option), {"chain": pa.string(), column: pa.int64()})
        if found is None:
            return {}
        rows = found.to_table().group_by("chain").aggregate([(column, "max")])
        return dict(zip(rows["chain"].to_pylist(), rows[f"{column}_max"].to_pylist(), strict=True))

    def initialOffset(self) -> dict:
        return self.at

    def latestOffset(self) -> dict:
        out = dict(self.at)
        for chain, head in self._highest("heads", "head").items():
            first = out[chain] + 1 if chain in out else max(self.deploy.get(chain, 0), 0)
            safe = max(head - self.confirmations, 0)
            if first <= safe:
                out[chain] = min(first + self.most, safe)
        return out

    def partitions(self, start: dict, end: dict) -> list[BlockRange]:
        self.at = dict(end)
        out = []
        for chain, last in end.items():
            first = start[chain] + 1 if chain in start else max(self.deploy.get(chain, 0), 0)
            out += [BlockRange(chain, at, min(at + self.split - 1, last)) for at in range(first, last + 1, self.split)]
        return out

    def read(self, partition: BlockRange) -> Iterator[pa.RecordBatch]:
        names = [*COLUMNS, "upto"]
        found = files(self.options["path"], COLUMNS)
        if found is not None:
            wanted = (pc.field("chain") == partition.chain) & (pc.field("block") >= partition.first) & (pc.field("block") <= partition.last)
            for batch in found.to_batches(filter=wanted):
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.nulls(batch.num_rows, pa.int64())], names=names)
        mark = {"chain": partition.chain, "block": partition.last}
        yield pa.RecordBatch.from_arrays([*(pa.array([mark.get(c)], kind) for c, kind in COLUMNS.items()), pa.array([partition.last], pa.int64())], names=names)


class BlockSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "blocks"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> BlockReader:
        return BlockReader(self.options)
