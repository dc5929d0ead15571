"""A small web console on the standard library: runs in the background, one at a time.

GET  /, /api/instruments, /api/status/<id>, /runs/<id>/<path>
POST /api/demo {instrument}, /api/upload (one raw file a request: ?name=&run=&instrument=&start=1),
     /api/ask {question}, /api/kb/add {source, text | url}
"""

from __future__ import annotations

import json
import logging
import shutil
import threading
import time
import urllib.error
import urllib.request
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from pathlib import Path
from urllib.parse import parse_qs, unquote, urlparse

from .operators.retrieval import PassageIndex, chunk_documents
from .plans.config import INSTRUMENTS, NightConfig
from .sources import knowledge
from .sources.fits import SUFFIXES
from .sources.uploads import IMAGES, TooLarge, clean_name, free_path, images_to_frames, unpack

log = logging.getLogger("nocturne.web")
KEPT_RUNS, REQUEST_BYTES, TEXT_BYTES = 20, 2 << 30, 2_000_000
TYPES = {".html": "text/html; charset=utf-8", ".json": "application/json", ".txt": "text/plain; charset=utf-8", ".md": "text/plain; charset=utf-8", ".png": "image/png"}
PAGE = "<!DOCTYPE html><title>Nocturne</title><h1>Nocturne</h1><p>POST /api/demo starts a synthetic night; see /api/status/&lt;id&gt; and /runs/&lt;id&gt;/reports/report.html.</p>"


def get_page(url: str, timeout: float = 20.0) -> tuple[int, dict[str, str], bytes]:
    """(status, headers, body) of one request; redirects are left to the caller."""

    class Stay(urllib.request.HTTPRedirectHandler):
        def redirect_request(self, *_):
            return None

    try:
        with urllib.request.build_opener(Stay).open(url, timeout=timeout) as r:
            return r.status, {k.lower(): v for k, v in r.headers.items()}, r.read(knowledge.URL_BYTES)
    except urllib.error.HTTPError as e:
        return e.code, {k.lower(): v for k, v in e.headers.items()}, b""


@dataclass
class Console:
    """State of the server: runs, their lock and the knowledge base."""

    spark: object
    root: Path
    runs: dict[str, dict] = field(default_factory=dict)
    lock: threading.Lock = field(default_factory=threading.Lock)
    notes: list[tuple[str, str]] = field(default_factory=list)
    index: PassageIndex | None = None
    get: Callable[[str], tuple[int, dict[str, str], bytes]] = field(default_factory=lambda: get_page)
    resolve: Callable[[str], list[str]] | None = None

    def prune(self, keep: int = KEPT_RUNS) -> None:
        """Keeps the newest finished runs; running ones are never touched."""
        done = sorted((r for r, s in self.runs.items() if s["state"] != "running"), key=lambda r: self.runs[r]["t0"])
        for r in done[: max(0, len(done) - keep)]:
            self.runs.pop(r)
            shutil.rmtree(self.root / r, ignore_errors=True)

    def sweep(self, keep: int = KEPT_RUNS) -> None:
        """At the start: folders of earlier servers beyond the newest."""
        old = sorted((p for p in self.root.glob("*") if p.is_dir()), key=lambda p: p.stat().st_mtime, reverse=True)
        for p in old[keep:]:
            shutil.rmtree(p, ignore_errors=True)

    def start(self, run: str, instrument: str, demo: bool, size: int = 512) -> None:
        self.runs[run] = {"state": "running", "message": "queued", "t0": time.time()}
        threading.Thread(target=self._work, args=(run, instrument, demo, size), daemon=True).start()

    def _work(self, run: str, instrument: str, demo: bool, size: int) -> None:
        from .plans.night import run_night
        from .plans.synth import Sky, generate_night

        state, base = self.runs[run], self.root / run
        with self.lock:  # one night at a time
            try:
                config = NightConfig(instrument=instrument)
                for name in ("raw", "master", "reduced", "catalogs", "reports"):
                    setattr(config.paths, name, str(base / name))
                if demo:
                    state["message"] = "making a synthetic night"
                    generate_night(self.spark, config.paths.raw, instrument, Sky(nx=size, ny=size))
                elif (base / "images").is_dir():
                    images_to_frames(self.spark, str(base / "images"), config.paths.raw)
                state["message"] = "reducing"
                result = run_night(self.spark, config)
                state |= {"state": "done", "message": "finished", "candidates": result.candidates.limit(10).count(), "report": f"/runs/{run}/reports/report.html"}
                self.index = None
            except Exception as e:  # noqa: BLE001  the state tells the user
                log.exception("run %s failed", run)
                state |= {"state": "error", "message": f"{type(e).__name__}: {e}"[:300]}

    def ask(self, question: str) -> dict:
        if self.index is None:
            latest = max((p for p in self.root.glob("*") if p.is_dir()), key=lambda p: p.stat().st_mtime, default=None)
            docs = knowledge.default_base(self.spark, str(Path(__file__).resolve().parents[1]), (str(latest),) if latest else ())
            if self.notes:
                docs = docs.unionByName(self.spark.createDataFrame(self.notes, "source string, text string"))
            self.index = PassageIndex.build(chunk_documents(docs, "source", "source"))
        return self.index.answer(question)

    def fetch(self, url: str) -> str:
        """The text of a public page; every hop is checked before it is asked."""
        return knowledge.fetch_page(url, self.get, self.resolve)

    def add(self, source: str, text: str) -> int:
        """Keeps a note for later indexes; one that stands takes it as a segment of its own."""
        if len(text) > TEXT_BYTES:
            log.warning("note %s is cut to %d of %d characters", source, TEXT_BYTES, len(text))
        self.notes.append((source, text[:TEXT_BYTES]))
        if self.index is not None:
            self.index.add(chunk_documents(self.spark.createDataFrame(self.notes[-1:], "source string, text string"), "source", "source"))
        return len(self.notes)

    def receive(self, run: str, name: str, stream, length: int) -> str:
        """Stores one file of a run: a frame, an image or an archive of frames."""
        base, low = self.root / run, clean_name(name).lower()
        folder = base / ("images" if low.endswith(IMAGES) else "raw")
        if not low.endswith((*SUFFIXES, *IMAGES, ".zip")):
            raise ValueError("neither a frame, an image nor an archive")
        folder.mkdir(parents=True, exist_ok=True)
        path = free_path(folder, clean_name(name))
        with path.open("wb") as out:
            while length > 0 and (part := stream.read(min(length, 1 << 20))):
                out.write(part)
                length -= len(part)
        if low.endswith(".zip"):
            try:
                unpack(path, folder)
            finally:
                path.unlink(missing_ok=True)
        return path.name


def handler(console: Console) -> type[BaseHTTPRequestHandler]:
    class Handler(BaseHTTPRequestHandler):
        def log_message(self, text: str, *args) -> None:
            log.debug(text, *args)

        def send(self, body, code: int = 200, kind: str = "application/json") -> None:
            raw = body if isinstance(body, bytes) else (body if isinstance(body, str) else json.dumps(body)).encode()
            self.send_response(code)
            self.send_header("Content-Type", kind)
            self.send_header("Content-Length", str(len(raw)))
            self.end_headers()
            self.wfile.write(raw)

        def do_GET(self) -> None:  # noqa: N802
            parts = [unquote(p) for p in urlparse(self.path).path.split("/") if p]
            if not parts:
                self.send(PAGE, kind=TYPES[".html"])
            elif parts == ["api", "instruments"]:
                self.send([{"id": k, "label": v.telescope} for k, v in INSTRUMENTS.items()])
            elif parts[:2] == ["api", "status"] and len(parts) == 3:
                state = console.runs.get(parts[2])
                self.send({**state, "elapsed": round(time.time() - state["t0"], 1)} if state else {"error": "unknown run"}, 200 if state else 404)
            elif parts[0] == "runs" and len(parts) > 2:
                base = (console.root / parts[1]).resolve()
                path = base.joinpath(*parts[2:]).resolve()
                if path.is_file() and path.is_relative_to(base) and base.is_relative_to(console.root.resolve()):
                    self.send(path.read_bytes(), kind=TYPES.get(path.suffix, "application/octet-stream"))
                else:
                    self.send({"error": "no such file"}, 404)
            else:
                self.send({"error": "no such page"}, 404)

        def do_POST(self) -> None:  # noqa: N802
            url, length = urlparse(self.path), int(self.headers.get("Content-Length") or 0)
            if length > REQUEST_BYTES:
                self.send({"error": "request too large"}, 413)
                return
            if url.path == "/api/upload":
                self.upload({k: v[-1] for k, v in parse_qs(url.query).items()}, length)
                return
            try:
                data = json.loads(self.rfile.read(length) or b"{}")
                data = data if isinstance(data, dict) else {}
            except ValueError:
                data = {}
            if url.path == "/api/demo":
                console.prune()
                run = uuid.uuid4().hex[:10]
                console.start(run, str(data.get("instrument", "dfot_2kx2k")), True, int(data.get("size", 512)))
                self.send({"run_id": run})
            elif url.path == "/api/ask":
                question = str(data.get("question", "")).strip()
                self.send(console.ask(question) if question else {"error": "empty question"}, 200 if question else 400)
            elif url.path == "/api/kb/add":
                text, link = str(data.get("text", "")).strip(), str(data.get("url", "")).strip()
                if link and not text:
                    try:
                        text = console.fetch(link)
                    except (ValueError, OSError) as e:
                        self.send({"error": str(e)}, 400)
                        return
                self.send({"notes": console.add(str(data.get("source") or link or "note"), text)} if text else {"error": "no text"}, 200 if text else 400)
            else:
                self.send({"error": "no such page"}, 404)

        def upload(self, args: dict[str, str], length: int) -> None:
            run = args.get("run") or uuid.uuid4().hex[:10]
            if clean_name(run) != run:
                self.send({"error": "bad run"}, 400)
                return
            try:
                name = console.receive(run, args.get("name", ""), self.rfile, length)
            except TooLarge as e:
                self.send({"error": str(e)}, 413)
                return
            except Exception as e:  # noqa: BLE001
                self.send({"error": str(e)}, 400)
                return
            if args.get("start"):
                console.start(run, args.get("instrument", "generic"), False)
            self.send({"run_id": run, "name": name})

    return Handler


def serve(spark, root: str = "web_data", host: str = "127.0.0.1", port: int = 8770) -> ThreadingHTTPServer:
    """A server that is ready to ``serve_forever``."""
    console = Console(spark, Path(root))
    console.root.mkdir(parents=True, exist_ok=True)
    console.sweep()
    server = ThreadingHTTPServer((host, port), handler(console))
    server.console = console
    return server
