"""Shared-storage paths and file-system calls through the session's Hadoop FS.

Everything that must be visible to every executor (scratch tables, checkpoints)
lives under the folder named by ``spark.checkpoint.dir``. Without that setting a
local session (unit tests, a laptop) gets a temporary folder; on a cluster it is an
error, as a folder of the driver's machine is not shared.

Published tables are versioned. ``<table>/v-<id>/`` holds the files of one publish and
numbered notes ``<table>/_current-<n>`` say which version is the table: the complete
note with the highest number. Publishing never renames or copies data; it adds one
small file. The version before stays for running readers until the next publish, and
longer if a consumer has pinned it (``_pin-<name>``).

A note may name the partitions of a version one by one, so a version can share the files
of unchanged partitions with versions before it. Every publish also adds an entry to
``<table>/_log/``, a folder that a stream can watch.
"""

from __future__ import annotations

import json
import re
import tempfile
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``); made only in local mode."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get(CHECKPOINT_CONF, None)
    if not d:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="stratalake-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


_scratch: dict[str, str] = {}  # application id -> its scratch folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path in the session's scratch folder, which lies in the shared
    folder and is deleted when the driver's JVM ends."""
    app = spark.sparkContext.applicationId
    if app not in _scratch:
        root = f"{shared_dir(spark).rstrip('/')}/scratch-{uuid.uuid4().hex}"
        fs, p = _fs(spark, root)
        fs.mkdirs(p)
        fs.deleteOnExit(p)
        _scratch[app] = root
    return f"{_scratch[app]}/{name}-{uuid.uuid4().hex}"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries directly under ``path`` (metadata only).

    Raises ``FileNotFoundError`` when ``path`` does not exist.
    """
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        raise FileNotFoundError(f"Directory not found: {path}")
    return [s.getPath().getName() for s in fs.listStatus(p)]


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file, from whatever file system ``path`` names."""
    fs, p = _fs(spark, path)
    ins = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(ins, "UTF-8")
    finally:
        ins.close()


# ---------------------------------------------------------------------------
# Numbered notes: small texts that are replaced as a whole
# ---------------------------------------------------------------------------
def _notes(spark: SparkSession, folder: str, name: str) -> list[int]:
    """Numbers of the notes ``name`` in ``folder``, highest first."""
    fs, p = _fs(spark, folder)
    if not fs.exists(p):
        return []
    pattern = re.compile(re.escape(name) + r"-(\d+)")
    found = (pattern.fullmatch(s.getPath().getName()) for s in fs.listStatus(p))
    return sorted((int(m[1]) for m in found if m), reverse=True)


def read_note(spark: SparkSession, folder: str, name: str) -> str | None:
    """Text of the newest complete note, or None.

    A note that its writer is still writing, or never finished, lacks the closing
    line feed; the one before it holds.
    """
    for n in _notes(spark, folder, name):
        text = read_text(spark, f"{folder.rstrip('/')}/{name}-{n:09d}")
        if text.endswith("\n"):
            return text[:-1]
    return None


def write_note(spark: SparkSession, folder: str, name: str, text: str) -> None:
    """Add the next note. Fails if another writer took the same number meanwhile.

    The two notes before it are kept, older ones deleted.
    """
    numbers = _notes(spark, folder, name)
    fs, p = _fs(spark, f"{folder.rstrip('/')}/{name}-{(numbers[0] if numbers else 0) + 1:09d}")
    out = fs.create(p, False)
    try:
        out.write(bytearray(f"{text}\n".encode()))
    finally:
        out.close()
    for n in numbers[2:]:
        delete(spark, f"{folder.rstrip('/')}/{name}-{n:09d}")


# ---------------------------------------------------------------------------
# Versioned tables
# ---------------------------------------------------------------------------
CURRENT = "_current"


def new_version(path: str) -> str:
    """Folder for the files of one publish of the table at ``path``."""
    return f"{path.rstrip('/')}/v-{uuid.uuid4().hex}"


@dataclass(frozen=True)
class Version:
    """What a table consists of after one publish.

    ``parts`` maps version folders to the partition folders that they contribute, each
    with a digest of its rows ("" if unknown); None means all of ``folder``.
    """

    number: int
    folder: str
    parts: dict[str, dict[str, str]] | None = None

    def folders(self) -> set[str]:
        return {self.folder} if self.parts is None else set(self.parts)

    def where(self) -> dict[str, str]:
        """Partition folder -> the version folder that holds it (empty if not listed)."""
        return {d: folder for folder, dirs in (self.parts or {}).items() for d in dirs}

    def digests(self) -> dict[str, str]:
        return {d: x for dirs in (self.parts or {}).values() for d, x in dirs.items()}

    def to_json(self) -> dict:
        return {"number": self.number, "current": self.folder, "parts": self.parts}

    @staticmethod
    def from_json(d: dict) -> Version:
        return Version(int(d.get("number") or 0), d["current"], d.get("parts"))


def _state(spark: SparkSession, path: str) -> tuple[int, dict]:
    """Number and content of the newest complete note; (0, {}) if there is none."""
    for n in _notes(spark, path, CURRENT):
        text = read_text(spark, f"{path.rstrip('/')}/{CURRENT}-{n:09d}")
        if text.endswith("\n"):
            return n, json.loads(text)
    return 0, {}


def current_version(spark: SparkSession, path: str) -> Version | None:
    """The version that is the table at ``path``; None for a folder never published to."""
    n, state = _state(spark, path)
    return Version(n, state["current"], state.get("parts")) if state.get("current") else None


def current_path(spark: SparkSession, path: str) -> str:
    """Where the newest files of the table at ``path`` are: its current version's own folder,
    or, for a folder that was never published to, ``path`` itself."""
    version = current_version(spark, path)
    return f"{path.rstrip('/')}/{version.folder}" if version else path


def partition_folders(spark: SparkSession, folder: str, depth: int) -> list[str]:
    """Partition folders (``a=1/b=2``) under ``folder`` (metadata only)."""
    fs, root = _fs(spark, folder)
    if not fs.exists(root):
        return []
    found = [""]
    for _ in range(depth):
        deeper = []
        for d in found:
            _, p = _fs(spark, f"{folder.rstrip('/')}/{d}" if d else folder)
            deeper += [f"{d}/{x.getPath().getName()}".lstrip("/") for x in fs.listStatus(p) if x.isDirectory() and "=" in x.getPath().getName()]
        found = deeper
    return sorted(found)


def promote(
    spark: SparkSession, path: str, version: str, parts: dict[str, dict[str, str]] | None = None, after: int | None = None
) -> Version:
    """Make the folder ``version`` (from :func:`new_version`), or ``parts``, the table at ``path``.

    The version it replaces is kept, as is what it shares or a consumer has pinned; what
    only the one before that needed is deleted. Versions that no note mentions belong to
    other runs and are left alone. ``after`` is the number of the note that ``parts`` was
    made from: if another publish came between, this one fails.
    """
    number, state = _state(spark, path)
    if after is not None and number != after:
        raise RuntimeError(f"{path} was published to meanwhile (note {number}, not {after})")
    before = Version(number, state["current"], state.get("parts")) if state.get("current") else None
    gone = set(state.get("previous_folders") or ([state["previous"]] if state.get("previous") else []))
    new = Version(number + 1, version.rstrip("/").rpartition("/")[2], parts)
    note = {"current": new.folder, "parts": parts, "previous": before.folder if before else None,
            "previous_folders": sorted(before.folders()) if before else []}
    write_note(spark, path, CURRENT, json.dumps(note))
    new = Version(_state(spark, path)[0], new.folder, parts)
    publish_log(spark, path)
    _delete_unused(spark, path, gone)
    return new


def _used(spark: SparkSession, path: str) -> set[str]:
    _, state = _state(spark, path)
    if not state:
        return set()
    kept = set(state["parts"]) if state.get("parts") is not None else set()
    kept |= {state.get("current"), state.get("previous"), *(state.get("previous_folders") or [])}
    for name in {m[1] for n in list_names(spark, path) if (m := re.fullmatch(r"(_pin-.+)-\d+", n))}:
        kept |= set(json.loads(read_note(spark, path, name) or "[]"))
    return kept - {None}


def _delete_unused(spark: SparkSession, path: str, folders: Iterable[str]) -> None:
    for f in set(folders) - _used(spark, path):
        delete(spark, f"{path.rstrip('/')}/{f}")


def pin(spark: SparkSession, path: str, name: str, versions: Iterable[Version] = ()) -> None:
    """Keep the files of ``versions`` for the consumer ``name``; what it had pinned before is let go."""
    note = f"_pin-{name}"
    had = set(json.loads(read_note(spark, path, note) or "[]"))
    want = sorted(set().union(*(v.folders() for v in versions)))
    write_note(spark, path, note, json.dumps(want))
    if gone := had - set(want):
        _delete_unused(spark, path, gone)


def version_exists(spark: SparkSession, path: str, version: Version) -> bool:
    return all(exists(spark, f"{path.rstrip('/')}/{f}") for f in version.folders())


LOG = "_log"
LOG_KEPT = 100


def log_path(path: str) -> str:
    return f"{path.rstrip('/')}/{LOG}"


def publish_log(spark: SparkSession, path: str) -> None:
    """Add the entry of the newest publish to the table's log if it is missing.

    Called by every publish after its note, and by consumers before they look: an entry
    that a crash between the two has left out is made up for. Old entries are deleted;
    a consumer needs the newest only.
    """
    version = current_version(spark, path)
    if version is None:
        return
    fs, p = _fs(spark, f"{log_path(path)}/{version.number:09d}.json")
    if not fs.exists(p):
        # under another name first, as a reader takes the file as soon as it is there
        _, part = _fs(spark, f"{log_path(path)}/.{uuid.uuid4().hex}")
        out = fs.create(part, False)
        try:
            out.write(bytearray((json.dumps(version.to_json()) + "\n").encode()))
        finally:
            out.close()
        if not fs.rename(part, p):
            fs.delete(part, False)  # another one has written it
    old = sorted(n for n in list_names(spark, log_path(path)) if n.endswith(".json"))[:-LOG_KEPT]
    for n in old:
        delete(spark, f"{log_path(path)}/{n}")


def clean_table(spark: SparkSession, path: str) -> list[str]:
    """Delete versions that are not current, previous, shared by them or pinned; return their names.

    Only for when no publish to ``path`` is running: they are then what crashed
    runs left behind.
    """
    if not _state(spark, path)[1]:
        return []
    keep = _used(spark, path)
    gone = [n for n in list_names(spark, path) if re.fullmatch(r"v-[0-9a-f]{32}", n) and n not in keep]
    for n in gone:
        delete(spark, f"{path.rstrip('/')}/{n}")
    return gone
