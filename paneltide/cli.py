"""Command line for the landing-file stages (spark-submit friendly).

  python -m paneltide.cli ingest   --landing DIR --out DIR
  python -m paneltide.cli merge    --landing DIR --census DIR --out DIR [--interpolate COL ...]
  python -m paneltide.cli analyze  --stages DIR --out DIR
  python -m paneltide.cli stream-ingest --landing DIR --out DIR [--checkpoint DIR]
  python -m paneltide.cli stream-wide --landing DIR --stage DIR [--checkpoint DIR]

Outputs are parquet folders, one per table.  Nothing is collected to the
driver except the small model results.
"""

from __future__ import annotations

import argparse

from .session import get_spark, sizing_conf
from .sources.sinks import read_stage, write_stage


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="paneltide")
    sub = ap.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("ingest")
    a.add_argument("--landing", required=True)
    a.add_argument("--out", required=True)
    m = sub.add_parser("merge")
    m.add_argument("--landing", required=True)
    m.add_argument("--census", required=True)
    m.add_argument("--out", required=True)
    m.add_argument("--interpolate", nargs="*", default=[])
    z = sub.add_parser("analyze")
    z.add_argument("--stages", required=True)
    z.add_argument("--out", required=True)
    st = sub.add_parser("stream-ingest")
    st.add_argument("--landing", required=True)
    st.add_argument("--out", required=True)
    st.add_argument("--checkpoint", default=None)
    sw = sub.add_parser("stream-wide")
    sw.add_argument("--landing", required=True)
    sw.add_argument("--stage", required=True)
    sw.add_argument("--checkpoint", default=None)
    ap.add_argument("--master", default=None)
    ap.add_argument("--input-gb", type=float, help="with --cores: sizes scan splits and shuffle partitions")
    ap.add_argument("--cores", type=int)
    args = ap.parse_args(argv)

    sizes = sizing_conf(int(args.input_gb * (1 << 30)), args.cores) if args.input_gb and args.cores else {}
    spark = get_spark(args.master, extra=sizes)
    if args.cmd == "ingest":
        from .sources.landing import crime_data, crime_rejects
        write_stage(crime_rejects(spark, args.landing), f"{args.out.rstrip('/')}/crime_rejects")
        write_stage(crime_data(spark, args.landing), f"{args.out.rstrip('/')}/crime_data")
    elif args.cmd == "merge":
        from .plans.stages import run_merge
        run_merge(spark, args.landing, args.census, out_dir=args.out, interpolate=args.interpolate)
    elif args.cmd == "analyze":
        from .plans.stages import analysis
        panels = [read_stage(spark, f"{args.stages.rstrip('/')}/{name}")
                  for name in ("acs_5_yearly_data", "acs_1_yearly_data", "crime_data_merged", "mapping_yearly_data")]
        res = analysis(*panels)
        for name, df in res.items():
            write_stage(df, f"{args.out.rstrip('/')}/{name}")
    elif args.cmd == "stream-ingest":
        from .streaming.landing import ingest_available
        ingest_available(spark, args.landing, args.out, args.checkpoint)
    elif args.cmd == "stream-wide":
        from .streaming.landing import maintain_crime_wide
        maintain_crime_wide(spark, args.landing, args.stage, args.checkpoint)


if __name__ == "__main__":
    main()
