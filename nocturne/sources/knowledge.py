"""Knowledge-base files, folders and pages as rows (source, text)."""

from __future__ import annotations

import ipaddress
import json
import re
import socket
from collections.abc import Iterator
from html.parser import HTMLParser
from pathlib import Path
from urllib.parse import unquote, urljoin, urlparse

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.discovery import numbered

TEXT_SUFFIXES = (".md", ".txt", ".py", ".yaml", ".yml", ".rst", ".log")
SKIPPED = frozenset(("script", "style", "nav", "footer", "header"))
JSON_CHARS, CSV_ROWS, URL_CHARS, URL_BYTES, REDIRECTS = 60_000, 399, 120_000, 2_000_000, 3


class _Text(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.depth, self.parts = 0, []

    def handle_starttag(self, tag: str, attrs) -> None:
        self.depth += tag in SKIPPED

    def handle_endtag(self, tag: str) -> None:
        if tag in SKIPPED and self.depth:
            self.depth -= 1

    def handle_data(self, data: str) -> None:
        if not self.depth and (text := data.strip()):
            self.parts.append(text)


def page_text(html: str | None) -> str:
    """Trimmed pieces of text outside scripts, styles and page furniture, one a line."""
    p = _Text()
    p.feed(html or "")
    p.close()
    return "\n".join(p.parts)


def html_to_text(pages: DataFrame, key: str, column: str) -> DataFrame:
    """key, text by a real parser, in Arrow batches."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({key: pdf[key], "text": [page_text(h) for h in pdf[column]]})

    return pages.select(key, column).mapInPandas(run, f"{key} {pages.schema[key].dataType.simpleString()}, text string")


def read_file(name: str, raw: bytes) -> str:
    """Text of one file by its suffix; unreadable bytes are replaced, byte-order marks honoured."""
    if raw[:2] in (b"\xff\xfe", b"\xfe\xff"):
        text = raw.decode("utf-16", "replace")
    else:
        text = raw.decode("utf-8-sig", "replace")
    low = name.lower()
    if low.endswith(".json"):
        try:
            return json.dumps(json.loads(text), indent=1)[:JSON_CHARS]
        except ValueError:
            return text[:JSON_CHARS]
    if low.endswith(".csv"):
        head, *rows = text.splitlines() or [""]
        return "\n".join([f"CSV {name}", f"columns: {head}", *rows[:CSV_ROWS]])
    if low.endswith((".html", ".htm")):
        return page_text(text)
    return text if low.endswith(TEXT_SUFFIXES) else ""


def credential_file(name: str) -> bool:
    """Whether a configuration file's name says that it holds credentials."""
    return "key" in name.lower() or "secret" in name.lower()


def read_files(spark: SparkSession, *paths: str, below: str | None = None) -> DataFrame:
    """source, text of knowledge-base files; the source is the name, or with ``below`` its folder's name and the path in it.

    Credentials among configuration files (.yaml, .yml) are left out; notes of any name are read.
    """
    files = spark.read.format("binaryFile").load(list(paths)).select("path", "content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            names = [unquote(p.rsplit("/", 1)[-1]) for p in pdf["path"]]
            kept = [not (n.lower().endswith((".yaml", ".yml")) and credential_file(n)) for n in names]
            inside = [_inside(p, below) if below else n for p, n in zip(pdf["path"], names, strict=True)]
            rows = [(i, read_file(n, c)) for i, n, c, on in zip(inside, names, pdf["content"], kept, strict=True) if on]
            yield pd.DataFrame(rows, columns=["source", "text"])

    return files.mapInPandas(run, "source string, text string").where("text <> ''")


def _inside(path: str, folder: str) -> str:
    """FOLDER's name and the path of a file below it."""
    where = unquote(urlparse(path).path) if "://" in path or path.startswith("file:") else path
    return f"{folder.rsplit('/', 1)[-1]}/{where[len(folder) + 1 :]}"


def within_caps(files: DataFrame, max_files: int, max_bytes: int, order: tuple[str, ...] = ("path",)) -> DataFrame:
    """The first files in order up to a count, and up to the one that reaches a running size.

    Rows are numbered without a single-task window; the sum of a bounded number of first rows is one.
    """
    first = numbered(files, *order).where(F.col("det_idx") < max_files)
    before = F.sum("length").over(Window.orderBy("det_idx")) - F.col("length")  # max_files rows at most
    return first.withColumn("_before", before).where(F.col("_before") < max_bytes).drop("_before", "det_idx")


def read_vault(spark: SparkSession, folder: str, max_files: int = 400, max_bytes: int = 8_000_000) -> DataFrame:
    """Notes (.md, .txt) of a folder tree as FOLDER/path; dot-folders and dot-files inside it are skipped, folders above it don't matter."""
    root = str(Path(folder).expanduser().resolve())
    notes = []
    for path in sorted(Path(root).rglob("*")):
        inside = path.relative_to(root).parts
        if path.suffix.lower() in (".md", ".txt") and path.is_file() and not any(part.startswith(".") for part in inside):
            notes.append((str(path), path.stat().st_size))
    if not notes:
        return read_files_schema(spark)
    kept = within_caps(spark.createDataFrame(notes, "path string, length long"), max_files, max_bytes)
    return read_files(spark, *[_escaped(r["path"]) for r in kept.orderBy("path").collect()], below=root)  # max_files at most


def _escaped(path: str) -> str:
    """A path without characters that file listings take for patterns."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def read_files_schema(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "source string, text string")


def blocked_reason(url: str, resolve=None) -> str | None:
    """Why a URL must not be fetched (scheme, host, private address), or None."""
    parts = urlparse(url)
    if parts.scheme not in ("http", "https"):
        return "only http and https are allowed"
    if not parts.hostname:
        return "no host"
    look_up = resolve or (lambda h: [x[4][0] for x in socket.getaddrinfo(h, None)])
    try:
        addresses = look_up(parts.hostname)
    except OSError:
        return "the host can't be resolved"
    for a in addresses:
        ip = ipaddress.ip_address(str(a).split("%")[0])
        if not ip.is_global or ip.is_multicast:
            return "the address isn't public"
    return None


def fetch_page(url: str, get, resolve=None) -> str:
    """Text of a page through ``get(url) -> (status, headers, body)``, every hop checked."""
    for _ in range(REDIRECTS + 1):
        if why := blocked_reason(url, resolve):
            raise ValueError(why)
        status, headers, body = get(url)
        if status in (301, 302, 303, 307, 308):
            url = urljoin(url, headers.get("location", ""))
            continue
        body = body[:URL_BYTES]
        text = body.decode("utf-8", "replace")
        return (page_text(text) if "html" in headers.get("content-type", "html") else text)[:URL_CHARS]
    raise ValueError("too many redirects")


def _listed(path) -> list[str]:
    """Lines of a list file in any common encoding, without blanks, comments and quotes."""
    raw = path.read_bytes()
    text = raw.decode("utf-16", "replace") if raw[:2] in (b"\xff\xfe", b"\xfe\xff") else raw.decode("utf-8-sig", "replace")
    return [s for line in text.splitlines() if (s := line.strip().strip('"')) and not s.startswith("#")]


def default_base(spark: SparkSession, root: str, data_dirs: tuple[str, ...] = (), get=None, resolve=None) -> DataFrame:
    """source, text of a project's notes: README and docs, configuration without credentials, the latest
    products, the files of kb/, and the pages and folders that kb/urls.txt and kb/sources.txt list.
    Pages need ``get``; one that can't be fetched is left out.
    """
    base = Path(root)
    files = [base / "README.md", *sorted((base / "docs").glob("*.md")), *(f for f in sorted((base / "config").glob("*.yaml")) if not credential_file(f.name))]
    for d in data_dirs:
        files += [Path(d) / n for n in ("reports/run_summary.txt", "reports/night_brief.md", "reports/qa_summary.json")] + [Path(d) / "catalogs" / "candidates.csv"]
    kb = base / "kb"
    files += [p for p in sorted(kb.iterdir()) if p.is_file() and p.name not in ("urls.txt", "sources.txt")] if kb.is_dir() else []
    there = [str(p) for p in files if p.is_file()]
    out = read_files(spark, *there) if there else read_files_schema(spark)
    if (kb / "sources.txt").is_file():
        for folder in _listed(kb / "sources.txt"):
            if Path(folder).is_dir():
                out = out.unionByName(read_vault(spark, folder))
    if get is not None and (kb / "urls.txt").is_file():
        pages = []
        for url in _listed(kb / "urls.txt"):
            try:
                pages.append((url, fetch_page(url, get, resolve)))
            except (ValueError, OSError):
                continue
        if pages:
            out = out.unionByName(spark.createDataFrame(pages, "source string, text string"))
    return out
