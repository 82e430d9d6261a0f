"""python -m glyphmill.cli generate|validate: the command lines."""

from __future__ import annotations

import argparse
import json
import sys


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="glyphmill")
    sub = p.add_subparsers(dest="command", required=True)
    g = sub.add_parser("generate")
    g.add_argument("--output", required=True)
    g.add_argument("--count", type=int, default=20)
    g.add_argument("--seed", type=int, default=1337)
    g.add_argument("--difficulty", choices=["normal", "dense"], default="normal")
    g.add_argument("--blocks-per-sample", type=int)
    g.add_argument("--content-provider")
    g.add_argument("--content-model")
    g.add_argument("--game-renderer", default="auto")
    g.add_argument("--no-augment", action="store_true")
    g.add_argument("--clean", action="store_true")
    g.add_argument("--sample-files", action="store_true")
    v = sub.add_parser("validate")
    v.add_argument("dataset")
    a = p.parse_args(argv)
    from pyspark.sql import SparkSession

    from . import api

    spark = SparkSession.builder.appName("glyphmill").getOrCreate()
    if a.command == "validate":
        out = api.validate_dataset(spark, a.dataset)
        print(json.dumps(out, ensure_ascii=False, indent=2))
        return int(out["error_count"] > 0)
    said = lambda e: print(f"{e['phase']}: {e['completed']}/{e['total']}", file=sys.stderr)
    out = api.generate_dataset(spark, a.output, a.count, a.seed, augment=not a.no_augment, clean=a.clean, difficulty=a.difficulty, blocks_per_sample=a.blocks_per_sample, content_provider=a.content_provider, content_model=a.content_model, game_renderer=a.game_renderer, sample_files=a.sample_files, progress=said)
    print(json.dumps(out, ensure_ascii=False, indent=2))
    return 0


if __name__ == "__main__":
    sys.exit(main())
