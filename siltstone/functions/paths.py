"""Names of repositories and paths, however they are written."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def plain_repo(repo: Column) -> Column:
    """The bare name of a repository in lower case: no host, owner, `.git`, blanks or slashes around; `_` is `-`."""
    text = F.regexp_replace(F.lower(repo), r"^[\s/]+|[\s/]+$", "")
    text = F.regexp_replace(text, r"\.git$", "")
    return F.translate(F.regexp_extract(text, r"([^/:\\]*)$", 1), "_", "-")


def plain_path(path: Column) -> Column:
    """A path with `/` between its parts, without empty and `.` parts; a part followed by `..` falls away with it."""
    parts = F.filter(F.split(F.translate(F.trim(path), "\\", "/"), "/"), lambda x: (x != "") & (x != "."))
    folded = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda done, x: F.when((x == "..") & (F.size(done) > 0), F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))).when(x == "..", done).otherwise(F.concat(done, F.array(x))),
    )
    # only paths that climb need the fold
    return F.when(F.contains(path, F.lit("..")), F.array_join(folded, "/")).otherwise(F.array_join(parts, "/"))


def directory(path: Column) -> Column:
    """The directory of a plain path; a file at the top is in ``."""
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)
