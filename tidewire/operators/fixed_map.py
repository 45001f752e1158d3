"""A reducing map that stays fixed while a window moves: fitted once, stored with its points, used for what arrives later.

Each fit is a generation folder under the window's; a pointer file names the one that holds and is written last, so a fit
that was cut short is never read. The default map is a principal-component one, from sums over all vectors; another
reducer is a pair of functions whose model is a dictionary of arrays."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

Model = dict[str, list]
POINTERS = ("current",)


def _moments(vectors: DataFrame, level: int = 0) -> DataFrame:
    """(n, s, o): counts, sums and sums of products of a partition's vectors; on level 1 of its rows of these."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, s, o = 0, None, None
        for pdf in batches:
            if not len(pdf):
                continue
            if level:
                dn, ds, do = int(pdf["n"].sum()), np.stack(pdf["s"]).sum(axis=0), np.stack(pdf["o"]).sum(axis=0)
            else:
                x = np.array(pdf["vector"].tolist(), dtype=np.float64)
                dn, ds, do = len(x), x.sum(axis=0), (x.T @ x).reshape(-1)
            n, s, o = n + dn, ds if s is None else s + ds, do if o is None else o + do
        if n:
            yield pd.DataFrame({"n": [n], "s": [s.tolist()], "o": [o.tolist()]})

    return vectors.mapInPandas(run, "n long, s array<double>, o array<double>")


def fit_components(vectors: DataFrame, dims: int) -> Model:
    """Mean and leading principal axes of all vectors; signs fixed by the largest entry of each axis.

    What the driver gathers is eight rows of dimension squared, whatever the number of vectors."""
    rows = _moments(_moments(vectors.select("vector")).repartition(8), 1).collect()
    n = sum(r["n"] for r in rows)
    mean = np.sum([r["s"] for r in rows], axis=0) / n
    cov = np.sum([r["o"] for r in rows], axis=0).reshape(len(mean), -1) / n - np.outer(mean, mean)
    _, v = np.linalg.eigh(cov)
    axes = v[:, ::-1][:, :dims].T
    axes = axes * np.sign(axes[np.arange(len(axes)), np.abs(axes).argmax(axis=1)])[:, None]
    return {"mean": mean.tolist(), "axes": axes.tolist()}


def apply_components(x: np.ndarray, model: Model) -> np.ndarray:
    return (x - np.array(model["mean"])) @ np.array(model["axes"]).T


@dataclass(frozen=True)
class Reducer:
    fit: Callable[[DataFrame, int], Model] = fit_components
    apply: Callable[[np.ndarray, Model], np.ndarray] = apply_components


class MapStore:
    """Maps of windows under ``root``/map."""

    def __init__(self, spark: SparkSession, root: str, reducer: Reducer = Reducer()):
        self.spark, self.root, self.reducer = spark, f"{root}/map", reducer

    def _path(self, text: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(text)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _exists(self, text: str) -> bool:
        fs, p = self._path(text)
        return fs.exists(p)

    def _write(self, text: str, content: str) -> None:
        """A small file that appears whole: written beside its place, then renamed."""
        fs, temp = self._path(f"{text}.{uuid.uuid4().hex}")
        out = fs.create(temp, True)
        out.write(bytearray(content.encode()))
        out.close()
        _, p = self._path(text)
        if fs.exists(p):
            fs.delete(p, False)
        fs.rename(temp, p)

    def _text(self, text: str) -> str:
        return "\n".join(r[0] for r in self.spark.read.text(text).collect())  # one small file

    def window(self, start: str) -> str:
        return f"{self.root}/window_start={start}"

    def active(self, start: str) -> str | None:
        """The folder of the window's map: the generation that the pointer names, or the window's own (maps of old); None if parts lack."""
        at = self.window(start)
        folder = f"{at}/{self._text(f'{at}/current')}" if self._exists(f"{at}/current") else at
        return folder if all(self._exists(f"{folder}/{x}") for x in ("model.json", "points", "meta.json")) else None

    def meta(self, start: str) -> dict | None:
        folder = self.active(start)
        return json.loads(self._text(f"{folder}/meta.json")) if folder else None

    def starts(self) -> list[str]:
        """Windows that have a whole map, in order."""
        if not self._exists(self.root):
            return []
        fs, p = self._path(self.root)
        names = sorted(s.getPath().getName().split("=", 1)[1] for s in fs.listStatus(p) if s.isDirectory() and s.getPath().getName().startswith("window_start="))
        return [n for n in names if self.active(n)]

    def _refit(self, vectors: DataFrame, start: str, setting: dict, dims: int) -> str:
        generation = f"gen={uuid.uuid4().hex}"
        folder = f"{self.window(start)}/{generation}"
        model = self.reducer.fit(vectors, dims)
        self._write(f"{folder}/model.json", json.dumps(model))
        self._project(vectors, model, False).write.parquet(f"{folder}/points")
        self._write(f"{folder}/meta.json", json.dumps(setting))
        self._write(f"{self.window(start)}/current", generation)
        fs, p = self._path(self.window(start))
        for s in fs.listStatus(p):  # a few entries
            if s.getPath().getName() not in (generation, *POINTERS):
                fs.delete(s.getPath(), True)
        return folder

    def _project(self, vectors: DataFrame, model: Model, transformed: bool) -> DataFrame:
        kind, apply = vectors.schema["article_id"].dataType.simpleString(), self.reducer.apply

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                if len(pdf):
                    points = apply(np.array(pdf["vector"].tolist(), dtype=np.float64), model)
                    yield pd.DataFrame({"article_id": pdf["article_id"], "point": points.astype(np.float32).tolist(), "transformed": transformed})

        return vectors.select("article_id", "vector").mapInPandas(run, f"article_id {kind}, point array<float>, transformed boolean")

    def points(self, vectors: DataFrame, start: str, dims: int, **setting) -> tuple[DataFrame, bool]:
        """(article_id, point) of all vectors, and whether the map was fitted anew: only where there is none or its settings differ.
        Points of former calls stay; what is new goes through the stored map and is stored too."""
        setting = {"dims": dims, **setting}
        folder, known = self.active(start), self.meta(start)
        fitted = known is None or any(known.get(k) != v for k, v in setting.items())
        if fitted:
            folder = self._refit(vectors, start, setting, dims)
        else:
            fresh = vectors.join(self.spark.read.parquet(f"{folder}/points").select("article_id"), "article_id", "left_anti")
            if not fresh.isEmpty():
                self._project(fresh, json.loads(self._text(f"{folder}/model.json")), True).write.mode("append").parquet(f"{folder}/points")
        return self.spark.read.parquet(f"{folder}/points").join(vectors.select("article_id"), "article_id", "left_semi").select("article_id", "point"), fitted
