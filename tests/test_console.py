"""Uploads, keys, the default knowledge base, denoising, stamps and the web console."""

import json
import threading
import urllib.error
import urllib.request
import zipfile

import numpy as np
import pytest

from nocturne.images import kernels
from nocturne.sources import keys, knowledge, uploads
from nocturne.web import serve


def test_names(tmp_path):
    assert uploads.clean_name("../../a b$.fits") == "a_b_.fits" and uploads.clean_name("...") == "upload"
    assert uploads.member_name("bias/../x/f 1.fits") == "bias__x__f_1.fits"
    (tmp_path / "a.fits").write_text("")
    assert uploads.free_path(tmp_path, "a.fits").name == "a_1.fits"


def test_archives_are_bounded(tmp_path):
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("a/f.fits", b"x" * 100)
        z.writestr("../b/f.fits", b"y")
        z.writestr("note.txt", b"no")
    (tmp_path / "raw").mkdir()
    assert sorted(p.name for p in uploads.unpack(tmp_path / "z.zip", tmp_path / "raw")) == ["a__f.fits", "b__f.fits"]
    with pytest.raises(uploads.TooLarge):
        uploads.unpack(tmp_path / "z.zip", tmp_path / "raw", member_bytes=50)


def test_images_become_frames(tmp_path, spark):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "moon.png").write_bytes(kernels.stamp_png(np.arange(64.0).reshape(8, 8)))
    assert uploads.images_to_frames(spark, str(tmp_path / "in"), str(tmp_path / "out")) == 1
    assert (tmp_path / "out" / "moon.fits").exists()


def test_keys(tmp_path, monkeypatch):
    (tmp_path / "config").mkdir()
    monkeypatch.delenv("NASA_API_KEY", raising=False)
    (tmp_path / "config" / "keys.yaml").write_text("nasa: abc")
    assert keys.load_keys(tmp_path) == {"NASA_API_KEY": "set"} and keys.load_keys(tmp_path) == {}
    (tmp_path / "config" / "keys.yaml").write_text("- a")
    assert keys.load_keys(tmp_path) == {}
    monkeypatch.delenv("NASA_API_KEY")


def test_default_base(tmp_path, spark):
    for d in ("docs", "config", "kb", "vault"):
        (tmp_path / d).mkdir()
    (tmp_path / "README.md").write_text("read me")
    (tmp_path / "config" / "keys.yaml").write_text("k: secret")
    (tmp_path / "config" / "a.yaml").write_text("gain: 2")
    (tmp_path / "kb" / "n.md").write_text("a note")
    (tmp_path / "vault" / "v.md").write_text("vault note")
    (tmp_path / "kb" / "sources.txt").write_bytes(f'# list\n"{tmp_path / "vault"}"\n'.encode("utf-16"))
    (tmp_path / "kb" / "urls.txt").write_bytes(b"\xef\xbb\xbfhttp://a.org/\nhttp://b.org/\n")
    get = lambda u: (200, {"content-type": "text/html"}, b"<p>page</p>")
    rows = {r.source for r in knowledge.default_base(spark, str(tmp_path), get=get, resolve=lambda h: ["8.8.8.8"] if h == "a.org" else ["127.0.0.1"]).collect()}
    assert rows == {"README.md", "a.yaml", "n.md", "vault/v.md", "http://a.org/"}


@pytest.mark.parametrize("method", ["tv", "bilateral", "wavelet", "unknown"])
def test_denoising(method):
    rng = np.random.default_rng(0)
    image = (100 + np.outer(np.ones(40), np.repeat([0.0, 50.0], 20)) + rng.normal(0, 4, (40, 40))).astype(np.float32)
    out = kernels.denoise(image, method)
    assert out.shape == image.shape and np.isfinite(out).all()
    if method == "unknown":
        assert (out == image).all()
    else:
        assert out[:, 3:17].std() < image[:, 3:17].std() and out[:, 25:].mean() - out[:, :15].mean() > 35


def test_console(tmp_path, spark):
    server = serve(spark, str(tmp_path / "web"), port=0)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_address[1]}"

    def call(path, data=None):
        raw = None if data is None else data if isinstance(data, bytes) else json.dumps(data).encode()
        try:
            with urllib.request.urlopen(urllib.request.Request(base + path, raw), timeout=60) as r:
                return r.status, r.read()
        except urllib.error.HTTPError as e:
            return e.code, e.read()

    try:
        assert call("/")[0] == 200 and len(json.loads(call("/api/instruments")[1])) == 5
        assert call("/api/status/none")[0] == 404 and call("/nope")[0] == 404
        assert call("/api/ask", {"question": " "})[0] == 400 and call("/api/ask", b"not json")[0] == 400
        assert call("/api/kb/add", {"source": "n", "text": "quasars flicker in the blue band over many nights of observation, " * 4})[0] == 200
        assert json.loads(call("/api/ask", {"question": "why do quasars flicker"})[1])["passages"][0]["source"] == "n"
        server.console.get = lambda u: (200, {"content-type": "text/html"}, b"<p>" + b"pulsars tick with the steadiness of clocks in the radio band, " * 4 + b"</p>")
        server.console.resolve = lambda h: ["8.8.8.8"] if h == "a.org" else ["10.0.0.1"]
        assert call("/api/kb/add", {"url": "http://a.org/p"})[0] == 200 and call("/api/kb/add", {"url": "http://b.org/p"})[0] == 400 and call("/api/kb/add", {})[0] == 400
        assert json.loads(call("/api/ask", {"question": "how do pulsars tick"})[1])["passages"][0]["source"] == "http://a.org/p"
        status, body = call("/api/upload?name=f.fits", b"abc")
        run = json.loads(body)["run_id"]
        assert status == 200 and call(f"/runs/{run}/raw/f.fits") == (200, b"abc")
        assert call("/api/upload?name=f.exe", b"abc")[0] == 400
        assert call(f"/runs/{run}/..%2f..%2fx")[0] == 404
        for i in range(3):
            server.console.runs[f"r{i}"] = {"state": "done", "t0": i}
        server.console.prune(1)
        assert list(server.console.runs) == ["r2"]
    finally:
        server.shutdown()


def test_log_file(tmp_path):
    import logging

    from nocturne.cli import set_up_logging

    root = logging.getLogger()
    before, level = list(root.handlers), root.level
    try:
        set_up_logging("INFO", str(tmp_path / "reports" / "night.log"))
        logging.getLogger("nocturne.test").info("frame %d done", 3)
        logging.getLogger("nocturne.test").debug("not shown")
        for h in root.handlers:
            h.flush()
        line = (tmp_path / "reports" / "night.log").read_text()
        assert "INFO nocturne.test: frame 3 done" in line and "not shown" not in line
    finally:
        for h in list(root.handlers):
            if h not in before:
                h.close()
        root.handlers[:] = before
        root.setLevel(level)
