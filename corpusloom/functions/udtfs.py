"""Table functions for SQL: ``register(spark)`` makes them known under their names."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from ..sources.members import tar_members
from ..sources.parsers import digest_articles
from .udfs import walk_strings


@udtf(returnType="field string, text string")
class WalkStrings:
    """Every string of a JSON text with its path."""

    def eval(self, value: str) -> Iterator[tuple]:
        yield from walk_strings(value) if value is not None else ()


@udtf(returnType="member_order int, path string, content binary")
class TarMembers:
    """The regular files of a tar archive."""

    def eval(self, data: bytes) -> Iterator[tuple]:
        yield from tar_members(bytes(data)) if data is not None else ()


@udtf(returnType="segment int, kind int, title string, authors array<string>")
class DigestArticles:
    """The articles of a digest page."""

    def eval(self, content: str) -> Iterator[tuple]:
        yield from digest_articles(content) if content is not None else ()


NAMES = {"walk_strings": WalkStrings, "tar_members": TarMembers, "digest_articles": DigestArticles}


def register(spark: SparkSession) -> None:
    for name, function in NAMES.items():
        spark.udtf.register(name, function)
