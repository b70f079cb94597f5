"""Input resolvers: what videos an artifact's payload leads to, through paths, folders and further JSON files.

Inputs: artifacts (artifact long, payload JSON text), tree (path, is_dir, text: the content of a JSON file). Paths are
absolute and without `.`, `..` or a slash at the end.

1. `reach` finds, by rounds of equi joins, all that an artifact can lead to: texts of the payload that are paths of the tree,
   texts of JSON files among these, and what lies in folders. A path is visited once an artifact, so circles end.
2. `videos` and `runtime_input` then decide, for each artifact over what it reaches, by the order in which places are
   tried. Order matters there (a place is tried only if those before it give nothing, and a JSON file is read once), so this
   is a walk in a task; an artifact's reach must fit in one.

Listings are capped as the rules say, by documented parameters: JSON files in order of their paths, 500 of a folder and its
children for `videos`, 200 below a folder for `runtime_input`, and 200 folders below it.
Texts that start with a scheme (`x://`) are remote and lead nowhere.
"""

from __future__ import annotations

import json
import posixpath
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framelake.sources.sinks import kept

#: Suffixes, file names in the order in which they are tried, and keys of payloads in theirs.
SUFFIXES = (".mp4", ".mov", ".avi", ".mkv", ".webm", ".m4v")
NAMES = ("rgb.mp4", "cam_head.mp4", "video.mp4")
COLLECTIONS = ("clips", "clipPaths", "clip_paths", "videos", "videoPaths", "video_paths", "files", "items", "entries", "artifacts", "segments", "segment_dirs")
VIDEO_KEYS = (
    "video", "videoPath", "video_path", "videoFile", "video_file", "localVideoPath", "local_video_path", "inputVideoPath", "input_video_path", "inputVideo", "input_video", "sourceVideoPath",
    "source_video_path", "inputPath", "input_path", "localPath", "local_path", "relativePath", "relative_path", "filePath", "file_path", "path",
)
PATH_KEYS = ("clipPath", "clip_path", "payloadPath", "manifestPath", "partitionDir", "rootPath", "root_path")
DIR_KEYS = ("episodeDir", "episode_dir", "workDir", "work_dir", "directory", "dir")
INNER_KEYS = ("data", "payload", "input", "result", "metadata", "item", "items", "entries", "videos", "files", "artifacts", "dataRef", "manifest", "partitions", "collections", "itemsByPartition", "entriesByPartition")
REF_KEYS = ("payloadPath", "manifestPath", "partitionDir")
ROOT_KEYS = ("payloadPath", "manifestPath", "partitionDir", "rootPath", "root_path")

VIDEO_JSONS, INPUT_JSONS, INPUT_DIRS = 500, 200, 200
#: Rounds of `reach` after which a chain of JSON files that goes on is taken for an error.
DEPTH = 64


def normal(path: Column) -> Column:
    """An absolute path without `.`, `..`, or double slashes; others as they are."""
    parts = F.split(path, "/")
    up = lambda acc: F.when(F.size(acc) > 0, F.slice(acc, F.lit(1), F.size(acc) - 1)).otherwise(acc)
    kept_ = F.aggregate(parts, F.array().cast("array<string>"), lambda acc, p: F.when(p.isin("", "."), acc).when(p == "..", up(acc)).otherwise(F.array_append(acc, p)))
    return F.when(path.startswith("/"), F.concat(F.lit("/"), F.array_join(kept_, "/"))).otherwise(path)


def _strings(text: Column) -> Column:
    """All JSON strings in a text, unescaped; keys, too."""
    raw = F.regexp_extract_all(text, F.lit(r'"((?:[^"\\]|\\.)*)"'), F.lit(1))
    return F.transform(raw, lambda x: F.coalesce(F.get(F.from_json(F.concat(F.lit('["'), x, F.lit('"]')), "array<string>"), F.lit(0)), x))


def _led(rows: DataFrame) -> DataFrame:
    """artifact, path of the texts in `text` that may be paths, relative ones from `base`."""
    got = rows.select("artifact", "base", F.explode(_strings(F.col("text"))).alias("s")).where("s <> '' AND NOT s RLIKE '^[a-zA-Z][a-zA-Z0-9+.-]*://'")
    whole = F.when(F.col("s").startswith("/") | F.col("base").isNull(), F.col("s")).otherwise(F.concat("base", F.lit("/"), "s"))
    return got.select("artifact", normal(whole).alias("path")).distinct()


def _parent(path: Column) -> Column:
    return F.regexp_replace(path, "/[^/]*$", "")


def _order(path: str = "path") -> Column:
    """Paths in order, folder by folder."""
    return F.split(path, "/")


def reach(artifacts: DataFrame, tree: DataFrame, deep: bool, depth: int = DEPTH) -> DataFrame:
    """artifact, path, is_dir, text: all that artifacts may lead to. With `deep`, of a folder the first INPUT_JSONS JSON
    files and INPUT_DIRS folders below it; else its own and its folders' files."""
    tree = tree.select("path", "is_dir", "text", _parent(F.col("path")).alias("parent"))
    below = tree.select("path", "is_dir", "text", F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.size(_order()) - 1, F.lit(1))), lambda i: F.array_join(F.slice(_order(), F.lit(1), i), "/"))).alias("above"))

    def listed(dirs: DataFrame) -> DataFrame:
        """artifact, path, is_dir, text of what lies in folders (artifact, path)."""
        d = dirs.select("artifact", F.col("path").alias("of"))
        own = d.join(tree, F.col("of") == F.col("parent")).select("artifact", "path", "is_dir", "text")
        if not deep:
            inner = own.where("is_dir AND NOT path RLIKE '/[.][^/]*$'").select("artifact", F.col("path").alias("of"))
            return own.union(inner.join(tree.where("NOT is_dir"), F.col("of") == F.col("parent")).select("artifact", "path", "is_dir", "text"))
        folders = d.select("of").distinct()
        place = F.row_number().over(Window.partitionBy("of", "is_dir").orderBy(_order()))
        some = below.where("is_dir OR lower(path) LIKE '%.json'").join(folders, F.col("of") == F.col("above")).withColumn("place", place).where(F.col("place") <= F.when(F.col("is_dir"), INPUT_DIRS).otherwise(INPUT_JSONS))
        far = d.join(some.select("of", "path", "is_dir", "text"), "of").select("artifact", "path", "is_dir", "text")
        inner = far.where("is_dir").select("artifact", F.col("path").alias("of"))
        return own.union(far).union(inner.join(tree.where("NOT is_dir"), F.col("of") == F.col("parent")).select("artifact", "path", "is_dir", "text"))

    seen: DataFrame | None = None
    new = _led(artifacts.select("artifact", F.lit(None).cast("string").alias("base"), F.col("payload").alias("text"))).join(tree.drop("parent"), "path").select("artifact", "path", "is_dir", "text")
    new = kept(new)
    for _ in range(depth):
        found = listed(new.where("is_dir"))
        texts = new.where("NOT is_dir AND text IS NOT NULL")
        led = _led(texts.select("artifact", _parent(F.col("path")).alias("base"), "text")).join(tree.drop("parent"), "path").select("artifact", "path", "is_dir", "text")
        seen = new if seen is None else seen.union(new)
        new = kept(found.union(led).dropDuplicates(["artifact", "path"]).join(seen.select("artifact", "path"), ["artifact", "path"], "left_anti"))
        if new.isEmpty():
            return seen
    raise RuntimeError(f"payloads still lead on after {depth} rounds")


class _Places:
    """What one artifact reaches."""

    def __init__(self, rows: dict[str, list], first: str):
        self.dirs = {p for p, d in zip(rows["path"], rows["is_dir"], strict=True) if d}
        self.texts = {p: t for p, d, t in zip(rows["path"], rows["is_dir"], rows["text"], strict=True) if not d}
        self.names = tuple(dict.fromkeys((first, *NAMES)))
        self.inside: dict[str, list[str]] = {}
        for p in sorted([*self.dirs, *self.texts], key=lambda p: p.split("/")):
            self.inside.setdefault(posixpath.dirname(p), []).append(p)
        self.read: set[str] = set()
        self.entered: set[str] = set()

    def at(self, text: str, base: str | None) -> str:
        path = text if text.startswith("/") or base is None else f"{base}/{text}"
        return posixpath.normpath(path) if path.startswith("/") else path

    def is_video(self, path: str) -> bool:
        return path in self.texts and path.lower().endswith(SUFFIXES)

    def own(self, folder: str) -> tuple[str | None, list[str]]:
        """The folder's video by name, and all its videos in order."""
        named = next((f"{folder}/{n}" for n in self.names if f"{folder}/{n}" in self.texts), None)
        return named, [p for p in self.inside.get(folder, []) if self.is_video(p)]

    def payload(self, path: str):
        """A JSON file's value, once; None if it was read before or can't be."""
        if path in self.read:
            return None
        self.read.add(path)
        try:
            return json.loads(self.texts[path] or "")
        except ValueError:
            return None


class _Videos(_Places):
    """All videos, in the order in which they are met."""

    def folder(self, path: str) -> list[str]:
        if path in self.entered:
            return []
        self.entered.add(path)
        if got := self.direct(path):
            return got
        inner = [p for p in self.inside.get(path, []) if p in self.dirs and not posixpath.basename(p).startswith(".")]
        if got := [v for p in inner for v in self.direct(p)]:
            return got
        jsons = [p for d in (path, *inner) for p in self.inside.get(d, []) if p in self.texts and p.lower().endswith(".json")]
        return [v for p in jsons[:VIDEO_JSONS] for v in self.place(p, path)]

    def direct(self, path: str) -> list[str]:
        named, all_ = self.own(path)
        return [named] if named else all_

    def place(self, text: str, base: str | None) -> list[str]:
        path = self.at(text, base)
        if self.is_video(path):
            return [path]
        if path in self.texts and path.lower().endswith(".json"):
            return self.value(self.payload(path), posixpath.dirname(path))
        return self.folder(path) if path in self.dirs else []

    def value(self, x, base: str | None) -> list[str]:
        if isinstance(x, str):
            return [] if "://" in x else self.place(x, base)
        if isinstance(x, list):
            return [v for y in x for v in self.value(y, base)]
        if not isinstance(x, dict):
            return []
        for y in [x[k] for k in COLLECTIONS if k in x] + [x[k] for k in ("clipPath", "clip_path", *VIDEO_KEYS, *PATH_KEYS) if isinstance(x.get(k), str) and x[k]]:
            if got := self.value(y, base):
                return got
        return [v for y in x.values() for v in self.value(y, base)]

    def all(self, artifact: dict) -> list[str]:
        data = artifact.get("data")
        text = lambda x: x if isinstance(x, str) and x and "://" not in x else None
        got = self.place(t, None) if (t := text(artifact.get("path"))) else []
        got += self.value(data, None)
        for ref in (artifact.get("dataRef"), data.get("dataRef") if isinstance(data, dict) else None):
            if isinstance(ref, dict):
                got += [v for k in REF_KEYS if (t := text(ref.get(k))) for v in self.place(t, None)]
        got = list(dict.fromkeys(got))
        return [p for p in got if not (posixpath.basename(p) in NAMES and any(q != p and q.startswith(posixpath.dirname(p) + "/") for q in got))]


class _Input(_Places):
    """The first input: (kind, path)."""

    def kind(self, path: str) -> tuple[str, str] | None:
        if self.is_video(path):
            return "video", path
        if path not in self.dirs:
            return None
        named, all_ = self.own(path)
        return ("episode", path) if named else ("video", all_[0]) if len(all_) == 1 else None

    def below(self, path: str, of: Callable[[str], bool]) -> list[str]:
        return sorted((p for p in (*self.texts, *self.dirs) if p.startswith(path.rstrip("/") + "/") and of(p)), key=lambda p: p.split("/"))

    def place(self, text: str, base: str | None) -> tuple[str, str] | None:
        path = self.at(text, base)
        if got := self.kind(path):
            return got
        if path in self.texts and path.lower().endswith(".json"):
            return self.value(self.payload(path), posixpath.dirname(path))
        if path not in self.dirs or path in self.entered:
            return None
        self.entered.add(path)
        for p in self.below(path, lambda p: p in self.texts and p.lower().endswith(".json"))[:INPUT_JSONS]:
            if got := self.place(p, path):
                return got
        return next((got for p in self.below(path, self.dirs.__contains__)[:INPUT_DIRS] if (got := self.kind(p))), None)

    def value(self, x, base: str | None) -> tuple[str, str] | None:
        if isinstance(x, str):
            return None if "://" in x else self.place(x, base)
        if isinstance(x, list):
            return next((got for y in x if (got := self.value(y, base))), None)
        if not isinstance(x, dict):
            return None
        texts = lambda keys, some: [x[k] for k in keys if isinstance(x.get(k), str) and (x[k] or not some)]
        tries = texts((*VIDEO_KEYS, *DIR_KEYS), False) + [x[k] for k in INNER_KEYS if k in x] + texts(ROOT_KEYS, True) + list(x.values())
        return next((got for y in tries if (got := self.value(y, base))), None)

    def first(self, artifact: dict) -> tuple[str, str] | None:
        data, ref = artifact.get("data"), artifact.get("dataRef") or {}

        def anew(t) -> tuple[str, str] | None:
            self.read, self.entered = set(), set()
            return self.place(t, None) if isinstance(t, str) and t and "://" not in t else None

        if got := anew(artifact.get("path")):
            return got
        self.read, self.entered = set(), set()
        if got := self.value(data, None):
            return got
        return next((got for k in REF_KEYS if (got := anew(ref.get(k)))), None) if isinstance(ref, dict) else None

    def shown(self, x) -> str:
        if not isinstance(x, str) or not x:
            return "<empty>"
        if "://" in x:
            return f"{x} [remote]"
        p = self.at(x, None)
        return f"{x} [{'dir' if p in self.dirs else 'file' if p in self.texts else 'missing'}, exists={p in self.dirs or p in self.texts}]"

    def checked(self, artifact: dict) -> str:
        data, ref = artifact.get("data"), artifact.get("dataRef")
        tried = [("path", artifact.get("path"))]
        for name, r in (("dataRef", ref if isinstance(ref, dict) else {}), ("data.dataRef", data.get("dataRef", {}) if isinstance(data, dict) else None)):
            if isinstance(r, dict):
                tried += [(f"{name}.{k}", r.get(k)) for k in REF_KEYS]
        return "; ".join(f"{k}={self.shown(v)}" for k, v in tried)


def _decide(artifacts: DataFrame, reached: DataFrame, of: Callable[[dict, dict[str, list]], list[tuple]], schema: str) -> DataFrame:
    """Rows that `of` makes of each artifact's payload and of what it reaches. Both are dealt by artifact to all tasks and stream
    by in order, the payload first; a task holds one artifact's rows at a time."""
    names = ("path", "is_dir", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, value, rows = None, None, {n: [] for n in names}

        def decided() -> list[tuple]:
            return [(key, *r) for r in of(value, rows)] if value is not None else []

        for batch in batches:
            out = []
            for artifact, payload, *cells in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if payload:
                    out += decided()
                    try:
                        value = json.loads(cells[2])
                    except (TypeError, ValueError):
                        value = {}
                    key, value, rows = artifact, value if isinstance(value, dict) else {}, {n: [] for n in names}
                else:
                    for n, c in zip(names, cells, strict=True):
                        rows[n].append(c)
            yield made(out)
        yield made(decided())

    def made(out: list[tuple]) -> pa.RecordBatch:
        kinds = [(c.split()[0], pa.int64() if c.endswith("long") else pa.string()) for c in schema.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, (_, t) in enumerate(kinds)], [n for n, _ in kinds])

    none = F.lit(None)
    one = artifacts.groupBy("artifact").agg(F.first("payload").alias("text"))
    one = one.select("artifact", F.lit(True).alias("payload"), none.cast("string").alias("path"), none.cast("boolean").alias("is_dir"), "text")
    # with a number of parts, they aren't put together by their bytes, which are few beside the work
    parts = int(artifacts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = one.union(reached.select("artifact", F.lit(False), *names)).repartition(parts, "artifact")
    return dealt.sortWithinPartitions("artifact", F.desc("payload")).mapInArrow(run, schema)


def videos(artifacts: DataFrame, tree: DataFrame, first: str = "rgb.mp4") -> DataFrame:
    """artifact, place (from 0), path: an artifact's videos in order, each once. `first` is the name that is tried first."""

    def of(value: dict, rows: dict[str, list]) -> list[tuple]:
        return list(enumerate(_Videos(rows, first).all(value)))

    return _decide(artifacts, reach(artifacts, tree, False), of, "artifact long, place long, path string")


def runtime_input(artifacts: DataFrame, tree: DataFrame, first: str = "rgb.mp4") -> DataFrame:
    """artifact, kind (video or episode), path, error: the first input; without one, what was checked."""

    def of(value: dict, rows: dict[str, list]) -> list[tuple]:
        got = _Input(rows, first)
        hit = got.first(value)
        return [(*hit, None) if hit else (None, None, f"no local video or episode folder. Checked: {got.checked(value)}")]

    return _decide(artifacts, reach(artifacts, tree, True), of, "artifact long, kind string, path string, error string")


def platform_inputs(artifacts: DataFrame, tree: DataFrame, first: str = "rgb.mp4") -> DataFrame:
    """artifact, place, kind, path, error: all videos; of artifacts that lead to none, the first input."""
    all_ = kept(videos(artifacts, tree, first))
    rest = runtime_input(artifacts.join(all_.select("artifact"), "artifact", "left_anti"), tree, first)
    none = F.lit(None).cast("string")
    return all_.select("artifact", "place", F.lit("video").alias("kind"), "path", none.alias("error")).unionByName(rest.select("artifact", F.lit(0).cast("long").alias("place"), "kind", "path", "error"))


def read_tree(spark, root: str, most_json: int = 64 << 20) -> DataFrame:
    """The tree below a folder, through Spark's readers: files, folders that hold any, and the content of JSON files."""
    load = lambda glob: spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)
    plain = lambda c: normal(F.regexp_replace(c, "^[a-z]+:(//[^/]*)?(?=/)", ""))
    files = load("*").select(plain(F.col("path")).alias("path"))
    texts = load("*.json").where(F.col("length") <= most_json).select(plain(F.col("path")).alias("path"), F.col("content").cast("string").alias("text"))
    parts = F.split("path", "/")
    dirs = files.select(F.explode(F.transform(F.sequence(F.lit(2), F.greatest(F.size(parts) - 1, F.lit(2))), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))).alias("path")).where("path <> ''").distinct()
    return files.join(texts, "path", "left").select("path", F.lit(False).alias("is_dir"), "text").union(dirs.select("path", F.lit(True), F.lit(None).cast("string")))
