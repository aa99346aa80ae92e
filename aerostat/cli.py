"""Command-line entry points for the daily jobs.

    python -m aerostat.cli transform --raw RAW --clean CLEAN [--day D | --days-back N]
    python -m aerostat.cli load      --clean CLEAN --serving SERVING [--day D ...]
    python -m aerostat.cli replace   --clean CLEAN --table T --table-root P [--day D] [--mode partition|version]
    python -m aerostat.cli backfill  --clean CLEAN --table T --table-root P [--days-back 7] [--end D]
    python -m aerostat.cli report    --clean CLEAN [--day D] [--part-glob GLOB]
    python -m aerostat.cli dashboard --table T [--day D] [--city C ...]
    python -m aerostat.cli dashboard --serving S [--day D] [--city C ...]    all frames from one scan
    python -m aerostat.cli absent    --clean CLEAN [--days-back 7] [--end D]  days that were never landed
    python -m aerostat.cli profile   --clean CLEAN [--day D]                  columns, merged over days

The day defaults to today in the feed's time zone (Asia/Bangkok), computed
once on the driver as a job parameter. Reports print bounded aggregate
frames only.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys
from zoneinfo import ZoneInfo

from aerostat.session import build_session

FEED_ZONE = "Asia/Bangkok"


def day_in_zone(days_back: int = 0, zone: str = FEED_ZONE, now: dt.datetime | None = None) -> dt.date:
    """Calendar day in ``zone`` minus ``days_back`` days (X6/X7 as a job parameter)."""
    now = now or dt.datetime.now(dt.timezone.utc)
    return now.astimezone(ZoneInfo(zone)).date() - dt.timedelta(days=days_back)


def window(days_back: int, end: dt.date) -> tuple[dt.date, dt.date]:
    """Inclusive ``[end - days_back, end]`` (X8: the 8-day backfill is ``days_back=7``)."""
    return end - dt.timedelta(days=days_back), end


def _days(args) -> list[dt.date]:
    if getattr(args, "day", None):
        return [dt.date.fromisoformat(d) for d in args.day]
    return [day_in_zone(args.days_back, args.zone)]


def _show(frames: dict, rows: int) -> None:
    for name, df in frames.items():
        print(f"== {name}")
        df.show(rows, truncate=False)


def main(argv: list[str] | None = None, spark=None) -> int:
    p = argparse.ArgumentParser(prog="aerostat")
    sub = p.add_subparsers(dest="cmd", required=True)

    def common(sp, day_multi=True):
        if day_multi:
            sp.add_argument("--day", action="append", help="YYYY-MM-DD; repeatable")
        sp.add_argument("--days-back", type=int, default=0)
        sp.add_argument("--zone", default=FEED_ZONE)

    t = sub.add_parser("transform")
    t.add_argument("--raw", required=True)
    t.add_argument("--clean", required=True)
    t.add_argument("--jsonlines", action="store_true", help="raw files are JSON lines, not one array")
    t.add_argument("--split-arrays", action="store_true", help="read each flight array by several tasks")
    t.add_argument("--condition-mode", default="intent", choices=["intent", "reference"])
    common(t)

    ld = sub.add_parser("load")
    ld.add_argument("--clean", required=True)
    ld.add_argument("--serving", required=True)
    common(ld)

    rp = sub.add_parser("replace")
    rp.add_argument("--clean", required=True)
    rp.add_argument("--table", required=True)
    rp.add_argument("--table-root", required=True)
    rp.add_argument("--mode", default="version", choices=["partition", "version"])
    common(rp)

    bf = sub.add_parser("backfill")
    bf.add_argument("--clean", required=True)
    bf.add_argument("--table", required=True)
    bf.add_argument("--table-root", required=True)
    bf.add_argument("--end", help="last file day, default today in --zone")
    bf.add_argument("--mode", default="version", choices=["partition", "version"])
    bf.add_argument("--days-back", type=int, default=7)
    bf.add_argument("--zone", default=FEED_ZONE)

    rep = sub.add_parser("report")
    rep.add_argument("--clean", required=True)
    rep.add_argument("--part-glob")
    rep.add_argument("--rows", type=int, default=20)
    common(rep)

    db = sub.add_parser("dashboard")
    shown = db.add_mutually_exclusive_group(required=True)
    shown.add_argument("--table")
    shown.add_argument("--serving", help="folder of a serving dataset")
    db.add_argument("--day")
    db.add_argument("--city", action="append")
    db.add_argument("--rows", type=int, default=20)

    ab = sub.add_parser("absent")
    ab.add_argument("--clean", required=True)
    ab.add_argument("--end", help="last day, default today in --zone")
    ab.add_argument("--days-back", type=int, default=7)
    ab.add_argument("--zone", default=FEED_ZONE)

    pr = sub.add_parser("profile")
    pr.add_argument("--clean", required=True)
    pr.add_argument("--rows", type=int, default=50)
    common(pr)

    args = p.parse_args(argv)
    spark = spark or build_session(app_name=f"aerostat-{args.cmd}")

    from aerostat import schemas
    from aerostat.operators import aggregate
    from aerostat.plans import daily, reports, serving
    from aerostat.sources import tables

    if args.cmd == "transform":
        n = daily.run(spark, args.raw, args.clean, _days(args), multiline=not args.jsonlines,
                      condition_mode=args.condition_mode, split_arrays=args.split_arrays)
        print(f"wrote {n} clean rows")
    elif args.cmd == "load":
        n = serving.load(spark, args.clean, args.serving, _days(args))
        print(f"loaded {n} serving rows")
    elif args.cmd == "replace":
        for d in _days(args):
            serving.replace_day(spark, args.table, args.table_root, args.clean, d, mode=args.mode)
    elif args.cmd == "backfill":
        end = dt.date.fromisoformat(args.end) if args.end else day_in_zone(0, args.zone)
        s, e = window(args.days_back, end)
        serving.backfill(spark, args.table, args.table_root, args.clean, s, e, mode=args.mode)
    elif args.cmd == "report":
        days = _days(args) if args.day else None
        _show(reports.adhoc(serving.read_clean(spark, args.clean, days, args.part_glob)), args.rows)
    elif args.cmd == "absent":
        end = dt.date.fromisoformat(args.end) if args.end else day_in_zone(0, args.zone)
        first, last = window(args.days_back, end)
        wanted = spark.sql(f"SELECT explode(sequence(DATE '{first}', DATE '{last}')) AS day")
        _show({"absent days": tables.absent_days(wanted, tables.landed_days(spark, args.clean)).orderBy("day")}, args.days_back + 1)
    elif args.cmd == "profile":
        rows = serving.read_clean(spark, args.clean, _days(args) if args.day else None)
        merged = aggregate.merged_profile(aggregate.profile(rows, ["ingest_date"])).orderBy("position")
        _show({"columns": merged}, args.rows)
    elif args.cmd == "dashboard" and args.serving:
        schema = schemas.SERVING_STORED
        if args.day:
            frames = reports.dashboard_frames(spark.read.schema(schema).parquet(args.serving), args.day, args.city)
        else:
            frames = reports.default_dashboard(spark, args.serving, schema, args.city)
        _show({"frames": frames.orderBy("frame", "key")}, args.rows)
    elif args.cmd == "dashboard":
        frames = reports.dashboard(spark.table(args.table), args.day, args.city)
        _show({**reports.options(spark.table(args.table)), **frames}, args.rows)
    return 0


if __name__ == "__main__":
    sys.exit(main())
