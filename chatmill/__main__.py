"""Command line: ``python -m chatmill <stage> ...`` runs one stage job."""

from __future__ import annotations

import argparse

from . import jobs
from .session import ensure_checkpoint_dir


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="chatmill")
    sub = ap.add_subparsers(dest="stage", required=True)
    v = sub.add_parser("verify")
    v.add_argument("manifest")
    c = sub.add_parser("clean")
    c.add_argument("raw_root")
    c.add_argument("out_dir")
    p = sub.add_parser("prepare")
    p.add_argument("cleaned_dir")
    p.add_argument("out_dir")
    p.add_argument("--profile", default="local", choices=["local", "full"])
    t = sub.add_parser("tokenize")
    t.add_argument("prepared_dir")
    t.add_argument("out_dir")
    t.add_argument("--profile", default="local", choices=["local", "full"])
    t.add_argument("--tokenizer-json", default=None, help="the model's tokenizers JSON file")
    args = ap.parse_args(argv)

    from pyspark.sql import SparkSession
    spark = SparkSession.builder.appName(f"chatmill-{args.stage}").getOrCreate()
    ensure_checkpoint_dir(spark)
    if args.stage == "verify":
        checks, verdict = jobs.verify_job(spark, args.manifest)
        checks.show(200, truncate=80)
        verdict.show(50, truncate=False)
    elif args.stage == "clean":
        jobs.clean_job(spark, args.raw_root, args.out_dir).show(50, truncate=False)
    elif args.stage == "prepare":
        jobs.prepare_job(spark, args.cleaned_dir, args.out_dir, args.profile).show(50, truncate=False)
    elif args.stage == "tokenize":
        jobs.tokenize_job(spark, args.prepared_dir, args.out_dir, args.profile,
                          tokenizer_json=args.tokenizer_json).show(truncate=False)


if __name__ == "__main__":
    main()
