"""Command-line entry points for the three stages (one scheduled task each).

    python -m stratalake bronze --url https://host/v1/items --param region=north --bronze PATH
    python -m stratalake bronze --fetcher pkg.module:callable --bronze PATH
    python -m stratalake silver --bronze PATH --silver PATH --config tables.yaml --table venues
    python -m stratalake silver ... --checkpoint PATH     # incremental: only new snapshots
    python -m stratalake gold   --silver PATH --gold PATH   --config tables.yaml --table venues \\
                                --keys country,state,venue_type --alias venue_count
    python -m stratalake clean --path PATH

The session comes from ``SparkSession.builder.getOrCreate()`` (master, memory
and ``spark.checkpoint.dir`` are set by ``spark-submit`` / the cluster). The
exit status is 0 on success, 2 when a quality gate blocks the write and 1 on
any other error. ``clean`` deletes what crashed publishes left in a table's folder
(see :func:`stratalake.sources.storage.clean_table`); run it while no publish runs.
"""

from __future__ import annotations

import argparse
import importlib
import logging
import sys

from ..operators.quality import VerificationError
from ..sources import storage
from ..sources.paged import HttpPages
from ..sources.schema import load_schema
from .stages import EntityColumns, to_bronze, to_gold, to_silver

log = logging.getLogger(__name__)


def _fetcher(spec: str):
    module, _, attr = spec.partition(":")
    obj = importlib.import_module(module)
    for part in attr.split("."):
        obj = getattr(obj, part)
    return obj


def _cols(a) -> EntityColumns:
    return EntityColumns(id=a.id_col, kind=a.kind_col, country=a.country_col, state=a.state_col,
                         lat=a.lat_col, lon=a.lon_col)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="stratalake")
    sub = p.add_subparsers(dest="stage", required=True)

    b = sub.add_parser("bronze", help="paged source -> dated raw snapshot")
    src = b.add_mutually_exclusive_group(required=True)
    src.add_argument("--fetcher", help="module:callable, called as fetch(page, per_page)")
    src.add_argument("--url", help="JSON REST endpoint paged with ?page=&per_page=")
    b.add_argument("--param", action="append", default=[], metavar="KEY=VALUE",
                   help="extra query parameter for --url (repeatable)")
    b.add_argument("--timeout", type=float, default=30.0)
    b.add_argument("--bronze", required=True)
    b.add_argument("--label", default=None)
    b.add_argument("--per-page", type=int, default=200)

    for name in ("silver", "gold"):
        s = sub.add_parser(name)
        s.add_argument("--config", required=True, help="YAML/JSON schema config")
        s.add_argument("--layer", default=name)
        s.add_argument("--table", required=True)
        s.add_argument("--silver", required=True)
        s.add_argument("--id-col", default="id")
        s.add_argument("--kind-col", default="kind")
        s.add_argument("--country-col", default="country")
        s.add_argument("--state-col", default="state")
        s.add_argument("--lat-col", default="latitude")
        s.add_argument("--lon-col", default="longitude")
        if name == "silver":
            s.add_argument("--bronze", required=True)
            s.add_argument("--mode", choices=["atomic", "sequential"], default="atomic")
            s.add_argument("--keep-empty-labels", action="store_true",
                           help="do not map '' partition labels to 'unknown'")
            s.add_argument("--multiline", action="store_true",
                           help="bronze files are JSON arrays (one document per file)")
            s.add_argument("--filename", default=None, help="read only this file of the newest snapshot")
            s.add_argument("--checkpoint", default=None,
                           help="process only snapshots that are new since the last run "
                                "(Structured Streaming, availableNow); its state lives here")
        else:
            s.add_argument("--gold", required=True)
            s.add_argument("--keys", default=None, help="comma-separated (default country,state,kind)")
            s.add_argument("--alias", default="n_entities")

    r = sub.add_parser("clean", help="delete versions that crashed publishes left behind")
    r.add_argument("--path", required=True, help="the published table's path")
    return p


def run(argv: list[str] | None = None, spark=None) -> int:
    a = parser().parse_args(argv)
    if spark is None:
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.appName(f"stratalake-{a.stage}").getOrCreate()
    try:
        if a.stage == "bronze":
            if a.url:
                params = dict(p.split("=", 1) for p in a.param)
                fetch = HttpPages(a.url, params, timeout=a.timeout)
            else:
                fetch = _fetcher(a.fetcher)
            path = to_bronze(spark, fetch, a.bronze, label=a.label, per_page=a.per_page)
            log.info("bronze snapshot: %s", path)
        elif a.stage == "clean":
            log.info("deleted: %s", storage.clean_table(spark, a.path) or "nothing")
        elif a.stage == "silver":
            schema = load_schema(a.config, a.layer, a.table)
            empty_as = None if a.keep_empty_labels else "unknown"
            if a.checkpoint:
                if a.filename:
                    raise ValueError("--filename cannot be combined with --checkpoint")
                from ..streaming.incremental import incremental_silver

                done = incremental_silver(spark, a.bronze, a.silver, schema, a.checkpoint,
                                          cols=_cols(a), mode=a.mode, empty_as=empty_as,
                                          multiline=a.multiline)
                log.info("published snapshots: %s", done or "none new")
            else:
                to_silver(spark, a.bronze, a.silver, schema, cols=_cols(a), mode=a.mode,
                          empty_as=empty_as, multiline=a.multiline, filename=a.filename)
        else:
            schema = load_schema(a.config, a.layer, a.table)
            c = _cols(a)
            keys = a.keys.split(",") if a.keys else [c.country, c.state, c.kind]
            to_gold(spark, a.silver, a.gold, schema, keys=keys, id_col=c.id, alias=a.alias)
    except VerificationError as e:
        log.error("quality gate failed: %s", e)
        return 2
    except Exception:
        log.exception("%s stage failed", a.stage)
        return 1
    return 0


def main() -> None:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s [%(levelname)s] %(message)s")
    sys.exit(run())
