"""What the jobs share: configuration, logging, the session of a command line."""

from __future__ import annotations

import argparse
import json
import logging
from collections.abc import Callable
from dataclasses import fields
from typing import Any, TypeVar

from pyspark.sql import SparkSession

T = TypeVar("T")


def settings_from(kind: type[T], given: dict[str, Any]) -> T:
    """A settings dataclass from a configuration's entries; an unknown entry is an error."""
    known = {f.name for f in fields(kind)}
    if strange := sorted(set(given) - known):
        raise ValueError(f"unknown settings: {', '.join(strange)}; known are {', '.join(sorted(known))}")
    return kind(**given)


def read_config(spark: SparkSession, path: str | None) -> dict[str, Any]:
    """The entries of a JSON file at any path that Spark reads; none without a path."""
    return json.loads(spark.read.text(path, wholetext=True).head()["value"]) if path else {}


def command_line(name: str, paths: dict[str, str], run: Callable[..., Any], settings: type, argv: list[str] | None = None) -> Any:
    """Parses paths and the configuration, runs the job in a session of its own and stops it."""
    parser = argparse.ArgumentParser(name)
    for path, text in paths.items():
        parser.add_argument(f"--{path}", required=True, help=text)
    parser.add_argument("--config", help="JSON file of settings")
    args = parser.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s: %(message)s")
    spark = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        return run(spark, **{p: getattr(args, p) for p in paths}, settings=settings_from(settings, read_config(spark, args.config)))
    finally:
        spark.stop()
