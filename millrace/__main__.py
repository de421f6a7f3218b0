"""python -m millrace build | verify | package | help"""

from __future__ import annotations

import argparse
import os
import sys

from millrace.release import BuildOptions, InvalidRelease, build_release, package_release, verify_release
from millrace.session import local_session
from millrace.streaming.progress import Progress, ProgressOptions


def _parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="millrace")
    commands = top.add_subparsers(dest="command", required=True)
    for name in ("build", "verify", "package"):
        p = commands.add_parser(name)
        if name == "build":
            p.add_argument("--input", required=True)
            p.add_argument("--output", required=True)
            p.add_argument("--dataset-version", required=True)
            p.add_argument("--artifact")
            p.add_argument("--chunk-size", type=int, default=50_000)
            p.add_argument("--worker-threads", type=int, default=os.cpu_count() or 1)
            p.add_argument("--index-memory-mb", type=int, default=512)
        else:
            p.add_argument("--release", required=True)
            if name == "package":
                p.add_argument("--artifact", required=True)
        p.add_argument("--progress-records", type=int)
        p.add_argument("--progress-interval-ms", type=int)
        p.add_argument("--progress-interval-seconds", type=int)
    commands.add_parser("help")
    return top


def progress_options(args: argparse.Namespace) -> ProgressOptions:
    """Flags come before the environment; milliseconds and seconds exclude each other."""

    def number(flag: int | None, name: str) -> int | None:
        return flag if flag is not None else int(os.environ[name]) if name in os.environ else None

    records = number(args.progress_records, "MILLRACE_PROGRESS_RECORDS")
    ms = number(args.progress_interval_ms, "MILLRACE_PROGRESS_INTERVAL_MS")
    seconds = number(args.progress_interval_seconds, "MILLRACE_PROGRESS_INTERVAL_SECONDS")
    if ms is not None and seconds is not None:
        raise ValueError("use only one of --progress-interval-ms or --progress-interval-seconds")
    wall = ms / 1000 if ms is not None else seconds if seconds is not None else 30.0
    return ProgressOptions(100_000 if records is None else records, wall)


def main(argv: list[str] | None = None) -> int:
    parser = _parser()
    args = parser.parse_args(argv)
    if args.command == "help":
        parser.print_help()
        return 0
    try:
        with Progress(progress_options(args)) as progress:
            spark = local_session()
            if args.command == "build":
                options = BuildOptions(
                    args.input, args.output, args.dataset_version, args.artifact, args.chunk_size, args.worker_threads, args.index_memory_mb * 1024 * 1024,
                    os.environ.get("MILLRACE_TRACE_BARCODE"), os.environ.get("MILLRACE_TRACE_EXPECT_UNIT"),
                )
                build_release(spark, options, progress)
            elif args.command == "verify":
                verify_release(spark, args.release, progress)
            else:
                package_release(spark, args.release, args.artifact, progress=progress)
    except (InvalidRelease, ValueError, OSError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
