"""Command line: demo, run, synth, init-config, instruments, ask and serve."""

from __future__ import annotations

import argparse
import logging
import sys
from pathlib import Path

from . import __version__
from .plans.config import INSTRUMENTS, NightConfig


def _paths(config: NightConfig, base: str) -> NightConfig:
    root = Path(base)
    for name in ("raw", "master", "reduced", "catalogs", "reports"):
        setattr(config.paths, name, str(root / name))
    return config


def set_up_logging(level: str = "INFO", log_file: str | None = None) -> None:
    handlers: list[logging.Handler] = [logging.StreamHandler()]
    if log_file:
        Path(log_file).parent.mkdir(parents=True, exist_ok=True)
        handlers.append(logging.FileHandler(log_file, mode="a"))
    logging.basicConfig(level=level, format="%(asctime)s %(levelname)s %(name)s: %(message)s", handlers=handlers, force=True)


def _show(result) -> None:
    result.candidates.select("obj_id", "kind", "rank_score", "ra", "dec", "n_det", "notes").show(10, truncate=60)


def cmd_demo(args) -> int:
    from .plans.night import run_night
    from .plans.synth import Sky, generate_night
    from .session import get_session

    config = _paths(NightConfig(instrument=args.instrument or "dfot_2kx2k"), args.out)
    spark = get_session()
    generate_night(spark, config.paths.raw, config.instrument, Sky(nx=args.size, ny=args.size))
    _show(run_night(spark, config))
    return 0


def cmd_run(args) -> int:
    from .plans.night import run_night
    from .session import get_session

    config = NightConfig.from_yaml(args.config) if args.config else NightConfig()
    if args.out:
        _paths(config, args.out)
    if args.raw:
        config.paths.raw = args.raw
    if args.instrument:
        config.instrument = args.instrument
    set_up_logging(config.log_level, str(Path(config.paths.reports) / "night.log"))
    _show(run_night(get_session(), config))
    return 0


def cmd_synth(args) -> int:
    from .plans.synth import Sky, generate_night
    from .session import get_session

    generate_night(get_session(), args.out, args.instrument or "dfot_2kx2k", Sky(nx=args.size, ny=args.size))
    return 0


def cmd_init_config(args) -> int:
    NightConfig().to_yaml(args.out)
    return 0


def cmd_instruments(args) -> int:
    for name, i in sorted(INSTRUMENTS.items()):
        print(f"{name:12} {i.telescope}: gain {i.gain}, read noise {i.read_noise}, {i.pixel_scale} arcsec/px, saturation {i.saturation:.0f}")
    return 0


def cmd_ask(args) -> int:
    from .operators.retrieval import PassageIndex, chunk_documents
    from .session import get_session
    from .sources.knowledge import read_files

    docs = read_files(get_session(), *args.files)
    index = PassageIndex.build(chunk_documents(docs, "source", "source"))
    print(index.answer(args.question)["answer"])
    return 0


def cmd_serve(args) -> int:
    from .session import get_session
    from .web import serve

    serve(get_session(), args.out, port=args.port).serve_forever()
    return 0


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser("nocturne", description="Time-domain sky catalogues on Spark")
    p.add_argument("--version", action="version", version=__version__)
    sub = p.add_subparsers(dest="command", required=True)
    for name, run, extra in (("demo", cmd_demo, ("out", "size")), ("run", cmd_run, ("config", "raw", "out_opt")), ("synth", cmd_synth, ("out", "size")), ("init-config", cmd_init_config, ("out",)), ("instruments", cmd_instruments, ()), ("ask", cmd_ask, ("ask",)), ("serve", cmd_serve, ("out", "port"))):
        c = sub.add_parser(name)
        c.set_defaults(run=run)
        c.add_argument("--instrument")
        if "out" in extra:
            c.add_argument("out")
        if "out_opt" in extra:
            c.add_argument("--out")
        if "size" in extra:
            c.add_argument("--size", type=int, default=512)
        if "config" in extra:
            c.add_argument("--config")
            c.add_argument("--raw")
        if "port" in extra:
            c.add_argument("--port", type=int, default=8770)
        if "ask" in extra:
            c.add_argument("question")
            c.add_argument("files", nargs="+")
    return p


def main(argv: list[str] | None = None) -> int:
    args = build_parser().parse_args(argv)
    set_up_logging()
    try:
        return args.run(args)
    except KeyboardInterrupt:
        return 130
    except Exception:  # noqa: BLE001  the shell gets a code, the log the reason
        logging.getLogger("nocturne").exception("%s failed", args.command)
        return 1


if __name__ == "__main__":
    sys.exit(main())
