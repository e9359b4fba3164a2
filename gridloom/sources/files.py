"""Files that Python workers write beside Spark's own tables, in any store that Arrow can open."""

from __future__ import annotations

import re
from functools import lru_cache

# Hadoop's names of stores, and Arrow's.
SCHEMES = {"file": "file", "hdfs": "hdfs", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss"}


def arrow_uri(folder: str) -> str:
    """The folder as Arrow names it; raises at once where Arrow has no such store."""
    found = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):(.*)", folder)
    if found is None:
        return f"file://{folder}"
    scheme, rest = found[1].lower(), found[2]
    if scheme == "dbfs":
        return f"file:///dbfs/{rest.lstrip('/')}"
    if scheme not in SCHEMES:
        raise ValueError(f"files can't be written under {folder}: of {scheme}:// stores only Spark's tables can be; set spark.checkpoint.dir to one of {', '.join(sorted(SCHEMES))}, dbfs")
    return f"{SCHEMES[scheme]}://{rest if rest.startswith('//') else '//' + rest}".replace(":////", "://")


@lru_cache(4)
def file_system(folder: str) -> tuple:
    """Arrow's file system of a folder, and the folder's path there."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(arrow_uri(folder))
