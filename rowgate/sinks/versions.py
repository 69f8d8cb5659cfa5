"""Outputs that change together (K1-K5): versions, one manifest, one commit.

Every run writes its rows of every output to a folder of its own,

    <root>/<output>/_version=<number>-<id>/<key>=<value>/...

and nothing that readers see changes until one file, the next
``<root>/manifest/<number>.json``, is put in place by a rename that fails if the
name is taken.  The manifest names the versions that are live in every output.  So
a run that dies at any point leaves all outputs at their old version, and of two
runs at once the second to commit fails (:class:`CommitConflict`).

A run replaces by *key* (the file date or file of its rows): its *claims*, a small
table of the keys it has read, hide the rows of these keys in older versions.
A static run hides older versions altogether.  Readers apply claims that are
pending as an anti join; after the commit, :meth:`Outputs.clean` deletes what they
hide, folder by folder, and publishes a manifest without them.  It can be run again
at any time.  What a dead run has written is deleted by the next one's cleaning.

``Outputs(spark, root).read(name)`` resolves all that.  Between runs the plain path
``<root>/<output>`` holds exactly the live rows too, for any reader, with the
column ``_version`` besides.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .writers import packed

VERSION = "_version"
#: Manifests that stay for readers that have begun with them.
KEPT_MANIFESTS = 3


class CommitConflict(RuntimeError):
    """Another run has committed since this one began; nothing was changed."""


class Files:
    """The few operations on folders that a commit needs, on any Hadoop file system."""

    def __init__(self, spark: SparkSession) -> None:
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.gateway = spark.sparkContext._gateway

    def path(self, text: str):
        return self.jvm.org.apache.hadoop.fs.Path(text)

    def system(self, text: str):
        return self.path(text).getFileSystem(self.conf)

    def names(self, folder: str) -> Iterator[str]:
        fs, path = self.system(folder), self.path(folder)
        if fs.exists(path):
            it = fs.listStatusIterator(path)
            while it.hasNext():
                yield it.next().getPath().getName()

    def read(self, file: str) -> str:
        stream = self.system(file).open(self.path(file))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put_new(self, file: str, text: str) -> bool:
        """Write a file under a name that nobody has taken; False if somebody has."""
        folder, name = file.rsplit("/", 1)
        tmp = self.path(f"{folder}/.{name}.{uuid.uuid4().hex}")
        fs = self.system(file)
        out = fs.create(tmp)
        out.write(bytearray(text.encode("utf-8")))
        out.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.conf)
        # without options, an existing name is not overwritten
        no_options = self.gateway.new_array(getattr(self.jvm, "org.apache.hadoop.fs.Options$Rename"), 0)
        try:
            context.rename(fs.makeQualified(tmp), fs.makeQualified(self.path(file)), no_options)
            return True
        except Exception as exc:
            fs.delete(tmp, False)
            if "FileAlreadyExistsException" in str(exc):
                return False
            raise

    def delete(self, path: str) -> None:
        self.system(path).delete(self.path(path), True)

    def size(self, folder: str) -> tuple[int, int]:
        """Files and bytes below a folder."""
        fs, path = self.system(folder), self.path(folder)
        if not fs.exists(path):
            return 0, 0
        s = fs.getContentSummary(path)
        return s.getFileCount(), s.getLength()


def _number(version: str) -> int:
    return int(version.split("-")[0])


class Outputs:
    """The committed state of all outputs below a folder."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root, self.files = spark, root.rstrip("/"), Files(spark)

    def manifest(self) -> dict:
        """The newest manifest; an empty one before the first commit."""
        newest = max((n for n in self.files.names(f"{self.root}/manifest") if n.endswith(".json") and not n.startswith(".")), default=None)
        if newest is None:
            return {"number": 0, "run": 0, "outputs": {}, "claims": []}
        return json.loads(self.files.read(f"{self.root}/manifest/{newest}"))

    def _publish(self, manifest: dict) -> None:
        if not self.files.put_new(f"{self.root}/manifest/{manifest['number']:08d}.json", json.dumps(manifest)):
            raise CommitConflict(f"{self.root}: another run has committed number {manifest['number']}")

    # ------------------------------------------------------------------ read
    def names(self) -> list[str]:
        return sorted(self.manifest()["outputs"])

    def read(self, name: str, manifest: dict | None = None) -> DataFrame:
        """The live rows of an output."""
        manifest = manifest or self.manifest()
        if name not in manifest["outputs"]:
            raise KeyError(f"{self.root} has no output {name!r}")
        out = manifest["outputs"][name]
        df = self._load(name, out["live"])
        pending = [c["version"] for c in manifest["claims"] if name in c["outputs"]]
        if pending and out["key"]:
            claims = self.claims(pending, name)
            hidden = F.col(out["key"]).cast("string").eqNullSafe(F.col("__claimed")) & (F.col(VERSION) < F.col("__by"))
            df = df.join(claims, hidden, "left_anti")
        return df.drop(VERSION)

    def _load(self, name: str, live: list[dict]) -> DataFrame:
        by_form: dict[str, list[dict]] = {}
        for v in live:
            by_form.setdefault(json.dumps([v["format"], v["options"], v["schema"]]), []).append(v)
        frames = []
        for versions in by_form.values():
            first = versions[0]
            schema = T.StructType.fromJson(first["schema"]).add(VERSION, T.StringType())
            frames.append(self.spark.read.format(first["format"]).options(**first["options"]).schema(schema)
                          .option("basePath", f"{self.root}/{name}").load([self._folder(name, v["version"]) for v in versions]))
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)

    def claims(self, versions: list[str], name: str) -> DataFrame:
        """``__claimed, __by``: keys that versions replace in an output."""
        frames = [self.spark.read.schema("key string, outputs array<string>").parquet(f"{self.root}/claims/{v}").where(F.array_contains("outputs", name))
                  .select(F.col("key").alias("__claimed"), F.lit(v).alias("__by")) for v in versions]
        return reduce(DataFrame.unionByName, frames)

    def _folder(self, name: str, version: str) -> str:
        return f"{self.root}/{name}/{VERSION}={version}"

    # ----------------------------------------------------------------- write
    def begin(self) -> "Version":
        return Version(self)

    def clean(self) -> None:
        """Delete what claims hide and what no live version holds; publish that."""
        manifest = self.manifest()
        for claim in manifest["claims"]:
            for name in claim["outputs"]:
                self._drop_claimed(name, manifest["outputs"][name], claim["version"])
        for name, out in manifest["outputs"].items():
            live = {v["version"] for v in out["live"]}
            for folder in list(self.files.names(f"{self.root}/{name}")):
                version = folder.removeprefix(f"{VERSION}=")
                if version != folder and version not in live and _number(version) <= manifest["run"]:
                    self.files.delete(f"{self.root}/{name}/{folder}")
        if manifest["claims"]:
            done = {**manifest, "number": manifest["number"] + 1, "claims": []}
            done["outputs"] = {name: {**out, "live": self._not_empty(name, out)} for name, out in manifest["outputs"].items()}
            self._publish(done)
        pending = {c["version"] for c in self.manifest()["claims"]}
        for version in list(self.files.names(f"{self.root}/claims")):
            if version not in pending and _number(version) <= manifest["run"]:
                self.files.delete(f"{self.root}/claims/{version}")
        for old in sorted(n for n in self.files.names(f"{self.root}/manifest") if n.endswith(".json") and not n.startswith("."))[:-KEPT_MANIFESTS]:
            self.files.delete(f"{self.root}/manifest/{old}")

    def _drop_claimed(self, name: str, out: dict, by: str) -> None:
        """Folders of claimed keys in versions before ``by``; the claims come one by one."""
        older = {v["version"]: set(self.files.names(self._folder(name, v["version"]))) for v in out["live"] if v["version"] < by}
        if not any(older.values()):
            return
        paths = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
        for row in self.claims([by], name).select("__claimed").toLocalIterator():
            folder = paths.getPartitionPathString(out["key"], row[0])
            for version, there in older.items():
                if folder in there:
                    self.files.delete(f"{self._folder(name, version)}/{folder}")

    def _not_empty(self, name: str, out: dict) -> list[dict]:
        """Live versions that still hold a folder of rows; the newest stays in any case."""
        keyed = f"{out['key']}="
        return [v for v in out["live"] if not out["key"] or v is out["live"][-1]
                or any(n.startswith(keyed) for n in self.files.names(self._folder(name, v["version"])))]

    def compact(self, target_bytes: int = 128 << 20) -> list[str]:
        """Rewrite outputs whose files are more than twice what their bytes need: one new
        version of packed files, committed like any other.  Gives their names."""
        manifest = self.manifest()
        version = self.begin()
        done = []
        for name, out in manifest["outputs"].items():
            counted = [self.files.size(self._folder(name, v["version"])) for v in out["live"]]
            n_files, n_bytes = sum(f for f, _ in counted), sum(b for _, b in counted)
            keys = len({k for v in out["live"] for k in self.files.names(self._folder(name, v["version"])) if k.startswith(f"{out['key']}=")})
            if len(out["live"]) > 1 and n_files > 2 * (keys + n_bytes // target_bytes + 1):
                last = out["live"][-1]
                version.write(name, self.read(name, manifest), key=out["key"], fmt=last["format"], options=last["options"], by=last["by"])
                done.append(name)
        if done:
            version.commit(replaces="all")
            self.clean()
        return done


class Version:
    """What one run writes; live after :meth:`commit`."""

    def __init__(self, outputs: Outputs) -> None:
        self.outputs, self.base = outputs, outputs.manifest()
        self.number = self.base["run"] + 1
        self.name = f"{self.number:08d}-{uuid.uuid4().hex[:8]}"
        self.written: dict[str, dict] = {}

    def write(self, name: str, df: DataFrame, *, key: str | None, by: Iterable[str] = (), fmt: str = "parquet", options: dict | None = None,
              order: str | None = None, pack: bool = True, append: bool = False, whole: bool = False, about: dict | None = None) -> None:
        """Rows of an output; ``key`` and ``by`` become folders.

        ``pack`` deals the rows into files of about the session's advisory size.  An
        ``append`` output keeps its older versions whatever the run replaces, a
        ``whole`` one none.  ``about`` stands in the manifest.
        """
        folders = [*([key] if key else []), *by]
        out = packed(df, folders, order) if pack else df
        writer = out.write.mode("errorifexists").format(fmt).options(**(options or {}))
        if folders:
            writer = writer.partitionBy(*folders)
        path = self.outputs._folder(name, self.name)
        writer.save(path)
        schema = T.StructType([*[f for f in df.schema if f.name not in folders], *[df.schema[c] for c in folders]])
        if fmt == "csv":
            schema = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
        form = {"version": self.name, "format": fmt, "options": options or {}, "by": list(by), "schema": json.loads(schema.json())}
        self.written[name] = {"key": key, "append": append, "whole": whole, "about": about or {}, "form": form}

    def own(self, name: str) -> DataFrame:
        """What this run has written of an output."""
        return self.outputs._load(name, [self.written[name]["form"]]).drop(VERSION)

    def commit(self, replaces: str | DataFrame = "all") -> None:
        """Make all outputs of this run live at once.

        ``replaces``: ``"all"`` that was in them, or ``key, outputs`` rows with the keys
        (as text) that they replace in each output.
        """
        files, root = self.outputs.files, self.outputs.root
        claims = list(self.base["claims"])
        if not isinstance(replaces, str):
            replaces.select(F.col("key").cast("string").alias("key"), "outputs").write.mode("errorifexists").parquet(f"{root}/claims/{self.name}")
            named = [n for n, w in self.written.items() if not w["append"]]
            claims.append({"version": self.name, "outputs": named})
        outputs = dict(self.base["outputs"])
        for name, w in self.written.items():
            stays = w["append"] or not (isinstance(replaces, str) or w["whole"])
            before = outputs.get(name, {"live": []})["live"] if stays else []
            outputs[name] = {"key": w["key"], "about": w["about"], "live": [*before, w["form"]]}
        if isinstance(replaces, str):
            claims = [{**c, "outputs": [n for n in c["outputs"] if n not in self.written or self.written[n]["append"]]} for c in claims]
            claims = [c for c in claims if c["outputs"]]
        files.system(root).mkdirs(files.path(f"{root}/manifest"))
        self.outputs._publish({"number": self.base["number"] + 1, "run": self.number, "outputs": outputs, "claims": claims})
