"""Commands: dedupe, screen, dispersion, codebook, freeze, release (section 2.16).

``python -m evspark COMMAND --help``. Exit codes: 0 fine, 1 findings, 2 error.
"""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from evspark.functions import jsonx
from evspark.operators import codebook, effects, linkage, provenance, screening
from evspark.sources import exports, files


def _session() -> SparkSession:
    return SparkSession.builder.appName("evspark").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def dedupe(a) -> int:
    spark, out = _session(), Path(a.output)
    if out.exists():
        raise ValueError("the output exists; choose a new one")
    rules = files.read_config(Path(a.rules), {"min_title_words": int, "similarity_threshold": float})
    raw = exports.read_files(spark, sorted(a.inputs)).cache()
    files.require_none(exports.same_files(raw).select("sha256"), "the same file twice")
    files.require_none(exports.unknown_formats(raw), "unknown formats")
    records = exports.collect(raw)
    files.require_none(exports.repeated_ids(records), "ids that a suffix repeats")
    decisions = files.read_decisions(spark, a.decisions) if a.decisions else None
    if decisions is not None:
        files.require_none(linkage.unknown_decisions(decisions, records), "decisions on unknown records")
    found = linkage.link(records, linkage.Rules.of(rules), decisions)
    for name, df, order in (("records", found.kept, ["record_id"]), ("ledger", found.ledger, ["record_id"]), ("review_pairs", found.review, ["pair_id"])):
        files.write_one_csv(df, out / f"{name}.csv", order)
    counts = found.counts.first().asDict()
    state = linkage.status(found.counts).first()[0]
    inputs = [r.asDict() for r in exports.file_summary(raw, records).orderBy("file").collect()]
    hashes = {f"{n}.csv": provenance.digest(out / f"{n}.csv") for n in ("records", "ledger", "review_pairs")}
    provenance.write_new(out / "summary.json", jsonx.pretty({"rules": a.rules, "inputs": inputs, "counts": counts, "status": state, "outputs": hashes}))
    return 0 if counts["balanced"] and state != "conflict" else 1


def screen(a) -> int:
    spark = _session()
    spec = files.read_config(Path(a.criteria), {"version": str, "criteria": list})
    table = lambda k: [screening.Criterion(**{f: tuple(v) if isinstance(v, list) else v for f, v in c.items()}) for c in spec.get(k, [])]
    first, full = table("criteria"), table("criteria_ft")
    screening.check_tables(first, full)
    if a.expect_sha256 and provenance.digest(Path(a.records)) != a.expect_sha256:
        raise ValueError("the records file is not the expected one")
    records = files.read_records(spark, a.records)
    text = None
    if a.phase == "ft":
        decided, sha = files.read_first_phase(spark, a.after_ta)
        if sha != provenance.digest(Path(a.records)):
            raise ValueError("the first phase read another records file")
        files.require_none(screening.coverage_gaps(records, decided), "records and decisions differ")
        ids = lambda p: files.read_id_list(spark, p) if p else records.select("record_id").limit(0)
        added, missing, texts = ids(a.after_ta_audit), ids(a.not_retrieved), files.read_full_texts(spark, a.texts)
        files.require_none(screening.list_errors(records, decided, added, missing, texts), "lists and texts")
        records = screening.full_text_input(records, decided, added, missing).join(texts.withColumnRenamed("text", "_full"), "record_id")
        text = "_full"
    criteria = full if a.phase == "ft" and full else first
    found = screening.screen(records, criteria, a.phase, spec["version"], text)
    files.write_screening(found, Path(a.output), Path(a.records), screening.evidence(records, criteria, a.phase, text))
    return 0


def dispersion(a) -> int:
    spark, ids = _session(), tuple(x.strip() for x in a.id_columns.split(",") if x.strip())
    rows = files.read_coded_rows(spark, a.rows, a.study_column, a.outcome_column, a.n_column, a.sd_column, ids)
    flags = effects.dispersion_flags(rows, a.ratio, a.study_column, a.outcome_column, a.n_column, a.sd_column, ids)
    note = F.when(F.col("rule") == "A", f"less than 1/{a.ratio:g} of another SD of the study and outcome").otherwise(f"less than 1/{a.ratio:g} of the typical SD of the outcome; fits after multiplying by the root of N")
    files.write_one_csv(flags.select(*ids, F.lit(a.sd_column).alias("field"), "value", "N", "rule", "reference_sd", note.alias("note")), Path(a.output), list(ids))
    return 0


def check(a) -> int:
    found = codebook.check_eligibility(Path(a.file), a.ready)[0] if a.eligibility else codebook.check_codebook(Path(a.file), a.ready, a.schema_version)
    print(jsonx.pretty({"mode": "ready" if a.ready else "draft", "checks_passed": found.passed, "findings": list(found)}), end="")
    return 0 if found.passed else 1


def freeze(a) -> int:
    root = Path(a.root)
    if a.action == "create":
        provenance.freeze(root, a.file, a.scope, a.manifest)
        return 0
    changes = provenance.verify(root, jsonx.strict((root / a.manifest).read_text(encoding="utf-8")))
    for path, change in changes[:20]:
        print(f"{change}: {path}")
    return 1 if changes else 0


def release(a) -> int:
    r = provenance.Releases(Path(a.project))
    if a.action == "create":
        r.create(a.name)
    elif a.action == "activate":
        r.activate(a.name)
    elif changes := r.verify(a.name or r.current()):
        print("\n".join(f"{c}: {p}" for p, c in changes[:20]))
        return 1
    return 0


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="evspark", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = p.add_subparsers(required=True)

    def command(name, f, *arguments):
        c = sub.add_parser(name)
        for flags, options in arguments:
            c.add_argument(*flags.split(), **options)
        c.set_defaults(run=f)

    need, many = {"required": True}, {"action": "append", "default": []}
    command("dedupe", dedupe, ("--inputs", need | {"nargs": "+"}), ("--rules", need), ("--output", need), ("--decisions", {}))
    command("screen", screen, ("phase", {"choices": ["ta", "ft"]}), ("records", {}), ("--criteria", need), ("--output", need), ("--after-ta", {}), ("--after-ta-audit", {}), ("--texts", {}), ("--not-retrieved", {}), ("--expect-sha256", {}))
    command("dispersion", dispersion, ("rows", {}), ("--output", need), ("--study-column", {"default": "Study_ID"}), ("--outcome-column", {"default": "Outcome_Metric"}), ("--n-column", {"default": "N"}),
            ("--sd-column", {"default": "sd"}), ("--id-columns", {"default": "Row_UID"}), ("--ratio", {"type": float, "default": 3.0}))
    command("codebook", check, ("file", {}), ("--ready", {"action": "store_true"}), ("--eligibility", {"action": "store_true"}), ("--schema-version", {"default": "codebook/1"}))
    command("freeze", freeze, ("action", {"choices": ["create", "verify"]}), ("--root", need), ("--manifest", need), ("--file", many), ("--scope", many))
    command("release", release, ("action", {"choices": ["create", "activate", "verify"]}), ("name", {"nargs": "?"}), ("--project", need))
    return p


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    try:
        return args.run(args)
    except (OSError, ValueError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main())
