"""Commit log of a target: small files that tell which loads are in.

A load is written first and recorded second, so one that breaks off leaves nothing for
readers and can be repeated. Commits are numbered files. Every label has a file of its own
name, so looking one up does not depend on how many there are, and no label is ever
forgotten. A single writer per target is assumed, which a streaming query or a scheduled
batch is.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from syncflow import storage

# Types that hold every value of the one before them.
_WIDENING = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())
_WIDENING_REAL = (T.FloatType(), T.DoubleType())


class CommitLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.commits, self.known = f"{path}/commits", f"{path}/labels"

    def _entry(self, version: int) -> dict:
        return json.loads(storage.read_text(self.spark, f"{self.commits}/{version:012d}.json"))

    def _label_path(self, label: str) -> str:
        digest = hashlib.sha256(label.encode()).hexdigest()
        return f"{self.known}/{digest[:2]}/{digest[2:34]}"

    def head(self) -> int:
        """Version of the last commit, -1 if there is none. The note of it may lag by a commit
        that was broken off after it was recorded."""
        note = f"{self.commits}/_head"
        version = int(storage.read_text(self.spark, note)) if storage.exists(self.spark, note) else -1
        while storage.exists(self.spark, f"{self.commits}/{version + 1:012d}.json"):
            version += 1
        return version

    def last(self) -> dict:
        """The last commit, or an empty one."""
        version = self.head()
        return self._entry(version) if version >= 0 else {}

    def has(self, label: str, owner: str | None = None) -> bool:
        """Whether a load is in. A label that another owner used is an error: the rows behind it
        are not those offered now."""
        path, last = self._label_path(label), self.last()
        if storage.exists(self.spark, path):
            entry = self._entry(int(storage.read_text(self.spark, path)))
        elif last.get("label") == label:
            entry = last
        else:
            return False
        if owner is not None and entry["owner"] is not None and entry["owner"] != owner:
            raise ValueError(f"label {label!r} was used by {entry['owner']!r}, not by {owner!r}")
        return True

    def since(self, key: str) -> list[dict]:
        """Commits, oldest first, from the last one that has ``key`` on (all if none has)."""
        entries, version = [], self.head()
        while version >= 0:
            entries.append(self._entry(version))
            if key in entries[-1]:
                break
            version -= 1
        return entries[::-1]

    def labels(self) -> list[str]:
        """Labels of the recorded loads, oldest first."""
        return [self._entry(v)["label"] for v in range(self.head() + 1)]

    def record(self, label: str, owner: str | None = None, **state) -> None:
        """Record a load with the state of the target after it."""
        version = self.head() + 1
        entry = json.dumps({"label": label, "owner": owner, "version": version, **state})
        storage.write_text(self.spark, f"{self.commits}/{version:012d}.json", entry)
        storage.write_text(self.spark, self._label_path(label), str(version))
        storage.write_text(self.spark, f"{self.commits}/_head", str(version))


def _wider(old: T.DataType, new: T.DataType) -> T.DataType | None:
    for chain in (_WIDENING, _WIDENING_REAL):
        if old in chain and new in chain:
            return chain[max(chain.index(old), chain.index(new))]
    return None


def _plain(kind: T.DataType) -> T.DataType:
    """The type with every part nullable, as files have it."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _plain(f.dataType)) for f in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_plain(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(_plain(kind.keyType), _plain(kind.valueType))
    return kind


def widened(stored: Mapping | None, offered: T.StructType) -> T.StructType:
    """The schema that holds stored and offered rows: columns may be added and numbers widened.

    Anything else is refused. Columns that are not offered stay, as NULL.
    """
    if stored is None:
        return _plain(offered)
    held = {f.name: f.dataType for f in T.StructType.fromJson(stored)}
    for field in _plain(offered):
        old = held.get(field.name, field.dataType)
        kind = old if old == field.dataType else _wider(old, field.dataType)
        if kind is None:
            raise ValueError(
                f"column {field.name!r} holds {old.simpleString()}, not {field.dataType.simpleString()}"
            )
        held[field.name] = kind
    return T.StructType([T.StructField(name, kind) for name, kind in held.items()])
