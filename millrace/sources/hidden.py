"""Text files whose names, or whose folders' names, begin with a dot or an underscore.

Spark's sources pass over such names.  They are found by a few globs, each one call that the driver's
JVM answers as a whole, level by level, so that no file costs a call of its own.  They are read by Spark's text
source like any other file, split and in parallel, through a mount that gives each file a plain name.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: What the mount puts before a name.
PLAIN = "plain-"
HIDDEN = "{_,.}*"


def _statuses(spark: SparkSession, pattern: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path) or []


def glob_names(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that a glob stands for, hidden ones too, in one call and one answer."""
    found, jvm = _statuses(spark, pattern), spark.sparkContext._jvm
    if not len(found):
        return []
    paths = jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(found)
    return jvm.scala.collection.immutable.ArraySeq.unsafeWrapArray(paths).mkString("\0").split("\0")


def hidden_files(spark: SparkSession, path: str, suffix: str = ".txt") -> list[str]:
    """Files below ``path``, which may be a glob, that a read of it would pass over, in order.

    A folder that the glob itself names is read whatever its name is; what counts are the names below
    it, and that of a file which the glob names.  As for a read, the driver's JVM sees all names, level by
    level; only hidden ones come to Python.
    """
    root = path.rstrip("/") or "/"

    def statuses(pattern: str):
        return _statuses(spark, pattern)

    def names(pattern: str) -> list[str]:
        return glob_names(spark, pattern)

    # Of the roots only files count; a folder with a hidden name is a root like any other.
    own = [status for status in statuses(root) if status.getPath().getName()[0] in "._"] if re.search(r"[{}\[\]*?\\]", root) else []
    listed, level = {status.getPath().toString() for status in own if status.isFile()}, "" if root == "/" else root
    while len(statuses(f"{level}/*")):
        below = f"{level}/{HIDDEN}"
        while deeper := names(below):
            listed.update(deeper)
            below += "/*"
        level += "/*"
    # A listed path with paths below it is a folder.
    folders = {folder for name in listed if (folder := name.rpartition("/")[0]) in listed}
    return sorted(name for name in listed - folders if name.endswith(suffix))


def _encoded(place: str) -> str:
    """A path as part of a URI, without characters that a glob has."""
    return re.sub(r"""[\x00-\x20\x7f"<>#%{}|\\^`\[\]?*]|\s""", lambda m: quote(m.group()), place)


def read_hidden(spark: SparkSession, files: list[str], whole_files: bool = False) -> DataFrame:
    """The lines of explicitly named files, whatever their names are: ``path, text``."""
    systems: dict[str, list[str]] = defaultdict(list)
    for name in files:
        system, place = re.fullmatch(r"(?s)([A-Za-z][\w+.-]*:(?://[^/]*)?)(/.*)", name).groups()
        systems[system].append(place)
    parts = []
    for system, places in systems.items():
        mount = "hidden-" + hashlib.sha256(system.encode()).hexdigest()[:16]
        link = f"fs.viewfs.mounttable.{mount}.linkRegex.#.^(?<dir>.*)/{PLAIN}(?<name>[^/]*)$"
        mapped = [re.sub(r"([^/]*)$", rf"{PLAIN}\1", _encoded(place), count=1) for place in places]
        # A setting of the session and not an option: options reach executors in lower case, where no mount has such a name.
        spark.conf.set(link, f"{system if '//' in system else system + '//'}${{dir}}/${{name}}")
        lines = spark.read.text([f"viewfs://{mount}{place}" for place in mapped], wholetext=whole_files)
        # Paths are shown encoded; these were encoded before, and an asterisk is shown as it is.
        seen = F.regexp_replace(F.col("_metadata.file_path"), f"^viewfs://{mount}(.*)/{PLAIN}([^/]*)$", f"{system}$1/$2")
        seen = F.replace(F.replace(seen, F.lit("%25"), F.lit("%")), F.lit("%2A"), F.lit("*"))
        parts.append(lines.select(seen.alias("path"), F.col("value").alias("text")))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
