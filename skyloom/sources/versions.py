"""Several tables under one manifest: every batch appears in all of them at once, and only once."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from skyloom.operators.ordering import with_row_index
from skyloom.operators.skew import pick_last
from skyloom.schemas import struct


@dataclass(frozen=True)
class Spec:
    """Columns of a table as DDL text; ``keys`` make a later row replace an earlier one, ``parts`` are folders, ``number`` is an id that is given out.

    Of rows of one batch with equal keys the last by ``order`` stays (without it the largest by all other columns).
    """

    schema: str
    keys: tuple[str, ...] = ()
    order: tuple[str, ...] = ()
    parts: tuple[str, ...] = ()
    number: str | None = None


@dataclass
class TableSet:
    """Parquet folders below ``path``, one for each batch and table, and numbered manifests that list them.

    A batch writes its own folders first and then the next manifest, which is renamed into place
    and never written over: readers see all of a batch or nothing, and of two writers that began
    with the same manifest the second fails and may try again. A batch that a manifest already names is
    not written again, so repeating an attempt changes nothing. Folders of failed attempts are in no
    manifest and are never read.
    """

    spark: SparkSession
    path: str
    specs: dict[str, Spec]
    state: dict = field(default_factory=dict)

    def __post_init__(self):
        self.refresh()

    def _files(self, path: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place, place.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def refresh(self) -> TableSet:
        """The newest manifest."""
        place, fs = self._files(f"{self.path}/manifest")
        names = sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else []
        names = [n for n in names if n.endswith(".json")]
        self.state = {"version": 0, "batches": [], "streams": {}, "folders": {}, "levels": {}, "next": {}}
        if names:
            self.state = json.loads(self._text(names[-1]))
        return self

    def _text(self, name: str) -> str:
        return self.spark.read.text(f"{self.path}/manifest/{name}", wholetext=True).first()["value"]

    def done(self, batch: str) -> bool:
        return batch in self.state["batches"]

    def folders(self, name: str) -> list[str]:
        return [f"{self.path}/{name}/commit={c}" for c in self.state["folders"].get(name, [])]

    def rows(self, name: str) -> DataFrame:
        """All rows of the current version with their ``commit``, replaced ones too."""
        schema, found = struct(f"{self.specs[name].schema}, commit string"), self.folders(name)
        if not found:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/{name}").parquet(*found)

    def read(self, name: str) -> DataFrame:
        """The current version: of rows with equal keys the one of the last batch."""
        spec, rows = self.specs[name], self.rows(name)
        if not spec.keys or len(self.folders(name)) < 2:
            return rows.drop("commit")
        columns = rows.drop("commit").columns
        return pick_last(rows, list(spec.keys), [F.col("commit")]).select(*columns)

    def numbered(self, name: str, rows: DataFrame, order: list) -> DataFrame:
        """Rows with the ids that follow the last one given out, in the given order."""
        return with_row_index(rows, order, "_at").withColumn(self.specs[name].number, F.col("_at") + F.lit(self.next_number(name))).drop("_at")

    def next_number(self, name: str) -> int:
        return self.state["next"].get(name, 1)

    def _typed(self, table: str, df: DataFrame) -> DataFrame:
        spec, columns = self.specs[table], struct(self.specs[table].schema)
        cells = [(F.col(c.name) if c.name in df.columns else F.lit(None)).cast(c.dataType).alias(c.name) for c in columns]
        typed = df.select(*cells)
        if not spec.keys:
            return typed
        others = [c.name for c in columns if c.name not in spec.keys]
        last = [F.col(c) for c in spec.order] or [F.struct(*others)]
        return pick_last(typed, list(spec.keys), last, others).select(*columns.names)

    def _write(self, table: str, rows: DataFrame, name: str) -> str:
        spec, columns = self.specs[table], struct(self.specs[table].schema).names
        target = f"{self.path}/{table}/commit={name}"
        if spec.parts:
            sorting = [*spec.parts, *[c for c in ("ra", spec.number) if c in columns]]
            rows = rows.repartitionByRange(*sorting).sortWithinPartitions(*sorting)
        rows.write.partitionBy(*spec.parts).parquet(target)
        return target

    def _new_name(self) -> str:
        return f"{self.state['version'] + 1:08d}-{uuid.uuid4().hex[:12]}"

    def commit(self, batch: str, rows: dict[str, DataFrame], instead: dict[str, DataFrame] | None = None, stream: tuple[str, int] | None = None) -> bool:
        """Appends ``rows`` to their tables, and puts the tables of ``instead`` in place of their old rows, as one step.

        False if the batch is known already: then nothing is written. A ``stream`` (its name and
        the rising number of its batch) is remembered by its last number instead of by the names of all its batches.
        """
        if self.done(batch) or (stream and self.state["streams"].get(stream[0], -1) >= stream[1]):
            return False
        name, state = self._new_name(), json.loads(json.dumps(self.state))
        for table, df in {**rows, **(instead or {})}.items():
            spec, whole = self.specs[table], table in (instead or {})
            target = self._write(table, self._typed(table, df), name)
            state["folders"][table] = [name] if whole else [*state["folders"].get(table, []), name]
            state["levels"][table] = [0] if whole else [*state["levels"].get(table, []), 0]
            if spec.number:
                top = self.spark.read.schema(f"{spec.number} bigint").parquet(target).agg(F.max(spec.number)).first()[0]
                state["next"][table] = max(state["next"].get(table, 1), (top or 0) + 1)
        if stream:
            state["streams"][stream[0]] = stream[1]
        else:
            state["batches"].append(batch)
        self._publish(state)
        return True

    def _publish(self, state: dict) -> None:
        state["version"] += 1
        target = f"{self.path}/manifest/{state['version']:08d}.json"
        draft, fs = self._files(f"{self.path}/manifest-drafts/{uuid.uuid4().hex}")
        place, _ = self._files(target)
        fs.mkdirs(place.getParent())
        out = fs.create(draft, False)
        out.write(json.dumps(state).encode())
        out.close()
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        kind = getattr(hadoop, "Options$Rename")
        how = self.spark.sparkContext._gateway.new_array(kind, 1)
        how[0] = kind.NONE  # fails if the version exists
        hadoop.FileContext.getFileContext(place.toUri(), self.spark._jsc.hadoopConfiguration()).rename(draft, place, how)
        self.state = state

    def merged(self, table: str, last: int) -> bool:
        """The last folders of a table as one, without the rows that later ones replaced; earlier folders stay as they are."""
        kept = self.state["folders"].get(table, [])
        if last < 2 or len(kept) < last:
            return False
        name, state = self._new_name(), json.loads(json.dumps(self.state))
        old = self.rows(table).where(F.col("commit").isin(kept[-last:]))
        spec, columns = self.specs[table], struct(self.specs[table].schema).names
        rows = pick_last(old, list(spec.keys), [F.col("commit")]).select(*columns) if spec.keys else old.select(*columns)
        self._write(table, rows, name)
        level = max(self.state["levels"][table][-last:]) + 1
        state["folders"][table], state["levels"][table] = [*kept[:-last], name], [*self.state["levels"][table][:-last], level]
        self._publish(state)
        return True

    def compacted(self, table: str) -> bool:
        """All folders of a table as one."""
        return self.merged(table, len(self.state["folders"].get(table, [])))

    def tidied(self, table: str, every: int) -> None:
        """Merges whenever ``every`` folders of one level stand at the end, so n batches leave folders in the order of log n.

        A row is written again once for each level, not with every batch.
        """
        while True:
            levels = self.state["levels"].get(table, [])
            run = next((i for i, x in enumerate(reversed(levels)) if x != levels[-1]), len(levels))
            if run < every or not self.merged(table, run):
                return

    def expire(self, keep: int = 3) -> int:
        """Removes manifests before the last ``keep`` and the folders that only they name; returns how many folders went.

        A reader that still works with a removed version fails and has to begin again.
        """
        place, fs = self._files(f"{self.path}/manifest")
        names = sorted(n for n in (x.getPath().getName() for x in fs.listStatus(place)) if n.endswith(".json"))
        old, new = ([json.loads(self._text(n))["folders"] for n in part] for part in (names[:-keep], names[-keep:]))
        listed = lambda states: {(t, c) for s in states for t, cs in s.items() for c in cs}
        gone = listed(old) - listed(new)
        for table, name in gone:
            folder, _ = self._files(f"{self.path}/{table}/commit={name}")
            fs.delete(folder, True)
        for name in names[:-keep]:
            file, _ = self._files(f"{self.path}/manifest/{name}")
            fs.delete(file, False)
        return len(gone)
