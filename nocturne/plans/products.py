"""Products of a night: tables, strict JSON, text summaries, dossiers and an HTML report.

Tables are written by Spark. Rendering collects only ranked top rows and one row a frame.
"""

from __future__ import annotations

import base64
import html
import json
import math
import shutil
from pathlib import Path
from typing import Any
from urllib.parse import unquote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import headers
from ..operators import motion
from ..sources import services
from .config import NightConfig

INTERESTING = ("mover", "transient", "variable")
CANDIDATE_COLUMNS = ["obj_id", "kind", "rank_score", "ra", "dec", "n_det", "frames", "mean_snr", "rb_score", "motion_arcsec_min", "motion_pa_deg", "var_chi2", "var_amp_mag", "notes"]


def sanitise(value: Any) -> Any:
    """NaN and infinities become null at every depth, so that the JSON is strict."""
    if isinstance(value, dict):
        return {k: sanitise(v) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [sanitise(v) for v in value]
    if isinstance(value, float) and not math.isfinite(value):
        return None
    return value


def write_json(path: Path, value: Any) -> Path:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(sanitise(value), indent=1, allow_nan=False))
    return path


def interesting(objects: DataFrame, top: int = 8) -> DataFrame:
    return objects.where(F.col("kind").isin(*INTERESTING)).orderBy(F.desc("rank_score"), "obj_id").limit(top)


def run_summary(result, n_frames: int) -> str:
    """Medians of the frame figures and the best interesting candidates."""
    mid = result.qa.agg(*[F.median(c).alias(c) for c in ("fwhm_arcsec", "zeropoint", "zp_scatter", "limiting_mag", "astrom_rms_arcsec")]).first()
    show = lambda v, n: "-" if v is None else f"{v:.{n}f}"
    counts = {r["kind"]: r["count"] for r in result.objects.groupBy("kind").count().collect()}  # a row a kind
    lines = [f"Night summary: {result.instrument.telescope or result.instrument.name}", f"Science frames: {n_frames}", f"Median seeing: {show(mid['fwhm_arcsec'], 2)} arcsec"]
    lines += [f"Median zero point: {show(mid['zeropoint'], 3)} mag, scatter {show(mid['zp_scatter'], 3)}", f"Median limiting magnitude: {show(mid['limiting_mag'], 2)}", f"Median astrometric residual: {show(mid['astrom_rms_arcsec'], 3)} arcsec"]
    lines.append("Objects: " + ", ".join(f"{n} {k}" for k, n in sorted(counts.items())))
    for r in interesting(result.objects).collect():
        lines.append(f"#{r['obj_id']} {r['kind']} rank {r['rank_score']:.3f} at {r['ra']:.5f} {r['dec']:+.5f}: {r['notes']}")
    return "\n".join(lines) + "\n"


def member_points(result, top: int = 8) -> DataFrame:
    """obj_id, kind, det_idx and the source row of every detection of the interesting objects."""
    members = interesting(result.objects, top).select("obj_id", "kind", F.explode("members").alias("m")).select("obj_id", "kind", "m.*")
    return result.sources.join(members, ["frame_index", "id"])


def _motions(points: DataFrame) -> dict[int, dict]:
    """Fitted motion of each mover by obj_id."""
    rows = motion.fit_motion(points.where("kind = 'mover'"), "obj_id").collect()  # a row a dossier
    ahead = lambda r: {f"+{h}": {"ra": r[f"ra_{h}"], "dec": r[f"dec_{h}"]} for h in ("1h", "24h")}
    return {r["obj_id"]: {**{k: r[k] for k in ("speed_arcsec_min", "pa_deg", "fit_rms_arcsec")}, "predictions": ahead(r), "arc_minutes": r["arc_minutes"], "n_epochs": r["n"]} for r in rows}


def answers(chosen: DataFrame, points: DataFrame, lights: DataFrame, fetch) -> DataFrame:
    """obj_id and what the services answer about each chosen object at the epoch of its middle detection."""
    middle = motion.middle_epoch(points, "obj_id", ["frame_index", "det_idx"]).select("obj_id", "frame").join(lights.select("frame", F.col("dateobs").alias("epoch")), "frame")
    asked = chosen.select("obj_id", "kind", "ra", "dec").join(middle.select("obj_id", "epoch"), "obj_id", "left")
    return services.read_replies(services.ask(asked, fetch), asked)


def dossiers(result, points: DataFrame, top: int = 8, fetch=None) -> list[dict]:
    """A record for each interesting object: verdict, checks and the motion fitted to its ``points``; ``fetch`` reaches the services."""
    chosen = interesting(result.objects, top)
    chosen = motion.identity_checks(chosen, answers(chosen, points, result.frames.where("ftype = 'light'"), fetch) if fetch else None)
    fitted = _motions(points)
    verdict, action = motion.verdict(F.col("kind"), F.col("checks"), F.col("speed"))
    rows = chosen.select("obj_id", "kind", "ra", "dec", F.round("rank_score", 4).alias("rank"), "notes", verdict.alias("verdict"), action.alias("action"), F.to_json("checks").alias("checks"), "n_det", "frames").collect()
    out = []
    for r in rows:
        d = r.asDict()
        d["checks"] = json.loads(d["checks"])
        d["motion"] = fitted.get(r["obj_id"], {})
        d["html_name"] = f"dossier_{r['obj_id']}.html"
        out.append(d)
    return out


def night_brief(records: list[dict]) -> str:
    lines = ["# Night brief", ""]
    for d in records:
        lines += [f"## Object {d['obj_id']}: {d['verdict']}", "", f"- kind {d['kind']}, rank {d['rank']}", f"- position {d['ra']:.6f} {d['dec']:+.6f}", f"- action: {d['action']}", *[f"- {c['service']}: {c['status']} ({c['detail']})" for c in d["checks"]], ""]
    return "\n".join(lines if records else [*lines, "Nothing to follow up."])


def _table(columns: list[str], rows: list[dict]) -> str:
    cell = lambda v: html.escape("" if v is None else f"{v:.4g}" if isinstance(v, float) else str(v))
    head = "".join(f"<th>{html.escape(c)}</th>" for c in columns)
    body = "".join("<tr>" + "".join(f"<td>{cell(r.get(c))}</td>" for c in columns) + "</tr>" for r in rows)
    return f"<table><thead><tr>{head}</tr></thead><tbody>{body}</tbody></table>"


def _page(title: str, body: str) -> str:
    style = "body{font-family:sans-serif;margin:2em}table{border-collapse:collapse}td,th{padding:.2em .6em;border:1px solid #ccc}"
    return f"<!DOCTYPE html><html><head><meta charset='utf-8'><title>{html.escape(title)}</title><style>{style}</style></head><body><h1>{html.escape(title)}</h1>{body}</body></html>"


def _trend(frames: list[dict], width: int = 480, height: int = 90) -> str:
    """Seeing, zero point and limiting magnitude over the frames as small line drawings."""
    out = []
    for name in ("fwhm_arcsec", "zeropoint", "limiting_mag"):
        points = [(i, f[name]) for i, f in enumerate(frames) if isinstance(f.get(name), float) and math.isfinite(f[name])]
        if len(points) > 1:
            lo, hi = min(v for _, v in points), max(v for _, v in points)
            at = " ".join(f"{10 + i * (width - 20) / max(1, len(frames) - 1):.1f},{height - 10 - (v - lo) / ((hi - lo) or 1.0) * (height - 20):.1f}" for i, v in points)
            out.append(f"<figure><svg width='{width}' height='{height}'><polyline fill='none' stroke='black' points='{at}'/></svg><figcaption>{name}: {lo:.3f} to {hi:.3f}</figcaption></figure>")
    return "<h2>Trends</h2>" + "".join(out) if out else ""


def _placed(points: list[tuple[float, float]], box: tuple[float, float, float, float], width: int, height: int, turned: tuple[bool, bool]) -> list[tuple[float, float]]:
    """Pixels of data points in a drawing; ``box`` is (x0, x1, y0, y1), ``turned`` the axes that grow the other way."""
    out = []
    for x, y in points:
        f, g = (x - box[0]) / ((box[1] - box[0]) or 1.0), (y - box[2]) / ((box[3] - box[2]) or 1.0)
        f, g = (1 - f if turned[0] else f), (g if turned[1] else 1 - g)
        out.append((round(34 + f * (width - 48), 1), round(12 + g * (height - 40), 1)))
    return out


def _ticks(box: tuple[float, float, float, float], width: int, height: int, turned: tuple[bool, bool], digits: tuple[int, int]) -> str:
    x0, x1 = (box[1], box[0]) if turned[0] else box[:2]
    top, bottom = (box[2], box[3]) if turned[1] else (box[3], box[2])
    text = lambda x, y, v, n, a="start": f"<text x='{x}' y='{y}' font-size='9' text-anchor='{a}'>{v:.{n}f}</text>"
    return text(34, height - 12, x0, digits[0]) + text(width - 14, height - 12, x1, digits[0], "end") + text(2, 20, top, digits[1]) + text(2, height - 30, bottom, digits[1])


def light_curve(points: list[dict], width: int = 420, height: int = 200) -> str:
    """Magnitude over time with error bars, bright at the top; calibrated magnitudes if every epoch has one, else instrumental ones."""
    rows = sorted((p for p in points if p["time_min"] is not None), key=lambda p: p["time_min"])
    name = "mag_calib" if all(_finite(p["mag_calib"]) for p in rows) else "mag_inst"
    rows = [p for p in rows if _finite(p[name])]
    if len(rows) < 2:
        return ""
    err = [max(1.0857 / max(p["snr"] or 0.0, 1e-3), 0.005) for p in rows]
    box = (rows[0]["time_min"], rows[-1]["time_min"], min(p[name] - e for p, e in zip(rows, err, strict=True)), max(p[name] + e for p, e in zip(rows, err, strict=True)))
    turned = (False, True)
    at = _placed([(p["time_min"], p[name]) for p in rows], box, width, height, turned)
    bars = [(a[0], a[1], b[1]) for a, b in zip(_placed([(p["time_min"], p[name] - e) for p, e in zip(rows, err, strict=True)], box, width, height, turned), _placed([(p["time_min"], p[name] + e) for p, e in zip(rows, err, strict=True)], box, width, height, turned), strict=True)]
    drawn = "".join(f"<line x1='{x}' x2='{x}' y1='{a}' y2='{b}' stroke='gray'/>" for x, a, b in bars) + f"<polyline fill='none' stroke='#2563eb' points='{' '.join(f'{x},{y}' for x, y in at)}'/>" + "".join(f"<circle cx='{x}' cy='{y}' r='3' fill='#2563eb'/>" for x, y in at)
    system = "calibrated" if name == "mag_calib" else "instrumental"
    return f"<figure class='light-curve'><svg width='{width}' height='{height}'>{drawn}{_ticks(box, width, height, turned, (1, 2))}</svg><figcaption>{system} magnitude over minutes since the first frame, {len(rows)} epochs</figcaption></figure>"


def track_figure(points: list[dict], fitted: dict, width: int = 320, height: int = 280) -> str:
    """Positions in time order with their frame numbers and where the fitted motion leads in an hour; right ascension grows to the left, without a jump at 0."""
    rows = sorted((p for p in points if _finite(p["ra"]) and _finite(p["dec"]) and p["time_min"] is not None), key=lambda p: p["time_min"])
    if len(rows) < 2:
        return ""
    ra = [rows[0]["ra"]]
    beside = lambda x: ra[-1] + (x - ra[-1] + 180.0) % 360.0 - 180.0
    for p in rows[1:]:
        ra.append(beside(p["ra"]))
    ahead = (fitted.get("predictions") or {}).get("+1h")
    spots = list(zip(ra, (p["dec"] for p in rows), strict=True)) + ([(beside(ahead["ra"]), ahead["dec"])] if ahead else [])
    box = (min(x for x, _ in spots), max(x for x, _ in spots), min(y for _, y in spots), max(y for _, y in spots))
    turned = (True, False)
    at = _placed(spots, box, width, height, turned)
    own = at[: len(rows)]
    drawn = f"<polyline fill='none' stroke='#b45309' points='{' '.join(f'{x},{y}' for x, y in own)}'/>" + "".join(f"<circle cx='{x}' cy='{y}' r='3' fill='#b45309'/><text x='{x + 5}' y='{y - 4}' font-size='9'>{int(p['frame_index'])}</text>" for (x, y), p in zip(own, rows, strict=True))
    if ahead:
        x, y = at[-1]
        drawn += f"<path d='M{x - 4} {y - 4}L{x + 4} {y + 4}M{x - 4} {y + 4}L{x + 4} {y - 4}' stroke='#b91c1c'/><text x='{x + 5}' y='{y + 10}' font-size='9' fill='#b91c1c'>+1h</text>"
    return f"<figure class='track'><svg width='{width}' height='{height}'>{drawn}{_ticks((box[0] % 360.0, box[1] % 360.0, *box[2:]), width, height, turned, (4, 4))}</svg><figcaption>right ascension and declination in degrees, by frame</figcaption></figure>"


def _finite(v: Any) -> bool:
    return v is not None and math.isfinite(v)


def html_report(result, summary: str, records: list[dict], images: dict[int, bytes] | None = None) -> str:
    """Summary, the best twelve candidates with their cutouts (``images`` by obj_id) and the frame figures."""
    best = [r.asDict() for r in result.candidates.limit(12).collect()]
    frames = [r.asDict() for r in result.qa.collect()]  # a row a frame
    links = "".join(f"<li><a href='{html.escape(d['html_name'])}'>{html.escape(d['verdict'])}</a></li>" for d in records)
    cut = "".join(f"<figure class='stamp'><img width='93' src='data:image/png;base64,{base64.b64encode(images[r['obj_id']]).decode()}'><figcaption>#{r['obj_id']} {html.escape(r['kind'])}</figcaption></figure>" for r in best if r["obj_id"] in (images or {}))
    shown = ["name", "n_sources", "n_cosmic_rays", "fwhm_arcsec", "sky_adu", "zeropoint", "zp_scatter", "limiting_mag", "astrom_rms_arcsec", "ok", "error"]
    return _page("Night report", f"<pre>{html.escape(summary)}</pre><h2>Candidates</h2>{_table(CANDIDATE_COLUMNS, best)}{cut}<ul>{links}</ul><h2>Frames</h2>{_table(shown, frames)}{_trend(frames)}")


def stamps(spots: list[dict], reduced: str, size: int = 31) -> list[bytes]:
    """PNG cutouts about (frame, x, y) from the reduced frames; spots off a frame or without one are left out."""
    from ..images.kernels import cutout, stamp_png
    from ..sources.fits import read_fits

    opened: dict[Path, Any] = {}
    out = []
    for r in spots:
        path = Path(reduced) / f"{Path(r['frame']).stem}_reduced.fits"
        if path not in opened:
            opened = {path: read_fits(path.read_bytes())[1] if path.exists() else None}  # one frame at a time
        if opened[path] is not None:
            part = cutout(opened[path], r["x"], r["y"], size)
            if min(part.shape) >= 4:
                out.append(stamp_png(part))
    return out


def candidate_spots(result, top: int = 12) -> DataFrame:
    """obj_id, frame, x, y of the brightest detection of each of the best candidates."""
    best = result.objects.orderBy(F.desc("rank_score"), "obj_id").limit(top).select("obj_id", F.explode("members").alias("m")).select("obj_id", "m.*")
    found = result.sources.join(best, ["frame_index", "id"])
    return found.groupBy("obj_id").agg(F.max_by(F.struct("frame", "x", "y"), F.struct("snr", "det_idx")).alias("s")).select("obj_id", "s.*")


REPORT_HEAD = ("COD XXX", "OBS nocturne (automated astrometry)", "NET reference catalogue of the night", "ACK draft, to be checked before it is sent")


def _forecast(found: dict) -> str:
    """The fitted motion of a mover and where it will be."""
    if not found:
        return ""
    head = f"{found['speed_arcsec_min']:.3f} arcsec/min at PA {found['pa_deg']:.1f}, fit rms {found['fit_rms_arcsec']:.2f} arcsec over {found['n_epochs']} epochs and {found['arc_minutes']:.1f} min"
    ahead = [{"after": k, "ra": f"{v['ra']:.5f}", "dec": f"{v['dec']:+.5f}"} for k, v in found["predictions"].items()]
    return f"<h2>Motion</h2><p>{html.escape(head)}.</p>{_table(['after', 'ra', 'dec'], ahead)}"


def dossier_page(d: dict, report: str, images: list[bytes] = (), figures: str = "") -> str:
    shown = "".join(f"<img width='93' src='data:image/png;base64,{base64.b64encode(i).decode()}'> " for i in images)
    checks = _table(["service", "status", "detail"], d["checks"])
    return _page(f"Object {d['obj_id']}: {d['kind']}", f"<p>{html.escape(d['verdict'])}. {html.escape(d['action'])}.</p><p>{html.escape(d['notes'] or '')}</p>{shown}{figures}{checks}{_forecast(d.get('motion') or {})}<h2>Astrometric report (draft)</h2><p>{'<br>'.join(map(html.escape, REPORT_HEAD))}</p><pre>{html.escape(report)}</pre>")


def report_lines(points: DataFrame, lights: DataFrame) -> DataFrame:
    """obj_id, time_min, det_idx, line: 80-column lines of all detections, with mid-exposure times; the line is null without a time."""
    found = points.join(lights.select("frame", "dateobs"), "frame")
    name = F.format_string("OBJ%04d", "obj_id")
    line = motion.report_line(name, F.col("ra"), F.col("dec"), headers.time_minutes(F.col("dateobs")), F.col("exptime"), F.col("mag_calib"))
    return found.select("obj_id", "time_min", "det_idx", line.alias("line"))


def frame_catalogs(sources: DataFrame, catalogs: Path) -> None:
    """A CSV a frame, written by one task each, as STEM_catalog.csv."""
    folder = catalogs / "_frames"
    flat = sources.select("*", F.col("frame").alias("_frame"))
    flat.repartition("_frame").sortWithinPartitions("_frame", "id").write.mode("overwrite").partitionBy("_frame").csv(str(folder), header=True)
    for part in folder.glob("_frame=*/*.csv"):
        part.replace(catalogs / f"{Path(unquote(part.parent.name.removeprefix('_frame='))).stem}_catalog.csv")
    shutil.rmtree(folder)


def write_products(result, config: NightConfig, fetch=None) -> dict[str, str]:
    """Writes catalogues, candidates, QA, dossiers, brief and report; returns their paths.

    ``fetch(service, ra, dec, epoch)`` gives the body of a service's reply; without it, or with
    dossiers_online off, the services are unavailable.
    """
    catalogs, reports = Path(config.paths.catalogs), Path(config.paths.reports)
    reports.mkdir(parents=True, exist_ok=True)
    result.sources.write.mode("overwrite").partitionBy("frame").parquet(str(catalogs / "all_sources"))
    frame_catalogs(result.sources, catalogs)
    candidates = result.candidates.select(*CANDIDATE_COLUMNS).toPandas()  # top_n rows
    if len(candidates):
        candidates.to_csv(catalogs / "candidates.csv", index=False)
    frames = [r.asDict() for r in result.qa.collect()]  # a row a frame
    n_ref = result.reference.count() if result.reference is not None else 0
    write_json(reports / "qa_summary.json", {"instrument": result.instrument.name, "telescope": result.instrument.telescope, "frames": frames, "reference_size": n_ref})
    summary = run_summary(result, len(frames))
    (reports / "run_summary.txt").write_text(summary)
    points = member_points(result)
    records = dossiers(result, points, fetch=fetch if config.discovery.dossiers_online else None) if config.discovery.dossiers else []
    write_json(reports / "dossiers.json", records)
    (reports / "night_brief.md").write_text(night_brief(records))
    lights = result.frames.where("ftype = 'light'")
    shown = ["obj_id", "frame", "frame_index", "det_idx", "time_min", "x", "y", "ra", "dec", "snr", "mag_inst", "mag_calib"]
    rows = [r.asDict() for r in points.select(*shown).orderBy("obj_id", "frame_index", "det_idx").collect()] if records else []  # a row a frame of each dossier
    lines = report_lines(points, lights).where("line is not null").orderBy("obj_id", "time_min", "det_idx").collect() if records else []
    for d in records:
        own = [r for r in rows if r["obj_id"] == d["obj_id"]]
        text = "\n".join(r["line"] for r in lines if r["obj_id"] == d["obj_id"])
        figures = (track_figure(own, d["motion"]) if d["kind"] == "mover" else "") + light_curve(own)
        (reports / d["html_name"]).write_text(dossier_page(d, text, stamps(own[:8], config.paths.reduced), figures))
    images = {r["obj_id"]: i[0] for r in candidate_spots(result).collect() if (i := stamps([r.asDict()], config.paths.reduced))}  # twelve rows
    (reports / "report.html").write_text(html_report(result, summary, records, images))
    return {"report": str(reports / "report.html"), "qa": str(reports / "qa_summary.json"), "summary": str(reports / "run_summary.txt"), "dossiers": str(reports / "dossiers.json"), "catalogs": str(catalogs)}
