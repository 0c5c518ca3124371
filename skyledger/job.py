"""The jobs to submit: ``spark-submit skyledger/job.py batch …`` or ``… stream …``."""

import argparse
import os
import sys
from concurrent.futures import ThreadPoolExecutor

if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from skyledger import fixed_values as fv  # noqa: E402
from skyledger.plans import refresh  # noqa: E402
from skyledger.session import build_session  # noqa: E402
from skyledger.sources.layers import Layers  # noqa: E402
from skyledger.sources.messages import read_batch, read_stream  # noqa: E402
from skyledger.streaming import ingest as streaming  # noqa: E402


def arguments(argv: list[str] | None) -> argparse.Namespace:
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("--root", required=True, help="folder of the layer tables")
    common.add_argument("--source", default="text", help="text, binaryFile, parquet, or kafka for a stream")
    common.add_argument("--path", help="folder of the messages")
    common.add_argument("--option", action="append", default=[], metavar="KEY=VALUE", help="option of the source")
    common.add_argument("--as-of", help="UTC time that stands for now, in replays")
    parser = argparse.ArgumentParser(description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)
    batch = jobs.add_parser("batch", parents=[common])
    batch.add_argument("--grid-start", default=fv.GRID_START)
    batch.add_argument("--grid-end", default=fv.GRID_END)
    batch.add_argument("--satellites", type=lambda ids: ids.split(","), help="the fleet, comma-separated")
    batch.add_argument("--step-minutes", type=int)
    batch.add_argument("--readings-per-tick", type=int)
    batch.add_argument("--batch-id", help="name of the batch; a named batch is stored once, however often it runs")
    batch.add_argument("--rebuild", action="store_true", help="make silver and gold anew from all stored rows")
    batch.add_argument("--publish", metavar="PREFIX", help="publish the tables in databases of this prefix")
    stream = jobs.add_parser("stream", parents=[common])
    stream.add_argument("--checkpoints", required=True, help="folder that all executors reach")
    stream.add_argument("--lateness", default=fv.ALLOWED_LATENESS)
    stream.add_argument("--every", default="1 minute", help="trigger interval")
    stream.add_argument("--until-empty", action="store_true", help="stop when all that has arrived is read")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> dict[str, int]:
    """Run one job; for a stream, the late rows by table once it ends."""
    given = arguments(argv)
    options = dict(pair.split("=", 1) for pair in given.option)
    spark = build_session(f"skyledger-{given.job}")
    layers = Layers(spark, given.root)
    if given.job == "batch":
        grid = {name: getattr(given, name) for name in ("satellites", "step_minutes", "readings_per_tick")}
        messages = read_batch(spark, given.source, given.path, **options)
        refresh.refresh(
            messages, layers, given.as_of, given.grid_start, given.grid_end, given.batch_id,
            **{name: value for name, value in grid.items() if value is not None},
        )
        if given.rebuild:
            refresh.rebuild(layers, refresh.Grid(given.grid_start, given.grid_end, {n: v for n, v in grid.items() if v is not None}))
        if given.publish is not None:
            layers.publish(given.publish)
        return {}
    messages = read_stream(spark, given.source, given.path, **options)
    trigger = {"availableNow": True} if given.until_empty else {"processingTime": given.every}
    queries = streaming.start(messages, layers, given.checkpoints, given.as_of, given.lateness, trigger)
    with ThreadPoolExecutor(len(queries)) as pool:
        return dict(zip(queries, pool.map(streaming.watch, queries.values()), strict=True))


if __name__ == "__main__":
    print(main())
