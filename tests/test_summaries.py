from __future__ import annotations

import json

import pytest

from tripmart.errors import SummaryError
from tripmart.sources.summaries import latest_summary, malformed_summaries, read_summaries


def document(year, month, valid=40, warning=7, rejected=5, **changes):
    """A sound summary whose counts add up, with a field that readers must not pass on."""
    return {
        "service": "yellow",
        "year": year,
        "month": month,
        "validated_at": f"{year}-{month:02d}-28T21:15:00Z",
        "total_rows": valid + warning + rejected,
        "status_counts": {"valid": valid, "warning": warning, "rejected": rejected},
        "rule_counts": {"duplicate_record": warning, "missing_fare_amount": rejected},
        "workspace": "/somewhere",
        **changes,
    }


def store(folder, name, payload):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{name}.json").write_text(json.dumps(payload, indent=1))


def test_the_last_month_wins(spark, tmp_path):
    months = [(2024, 11), (2025, 3), (2024, 12), (2025, 2)]
    for n, (year, month) in enumerate(months):
        store(tmp_path, f"validation_{year}_{month:02d}", document(year, month, valid=100 + n))
    summary = latest_summary(spark, str(tmp_path))
    assert (summary["year"], summary["month"], summary["artifact_name"]) == (2025, 3, "validation_2025_03")
    assert summary["status_counts"]["valid"] == 101 and summary["total_rows"] == 113
    assert summary["rule_counts"] == {"duplicate_record": 7, "missing_fare_amount": 5} and "workspace" not in summary


def test_only_the_last_part_of_a_path_names_a_document(spark, tmp_path):
    root = tmp_path / "validation_2031_01_old" / "artifact_name=validation_2030_09" / "deep"
    for year, month in ((2024, 6), (2024, 5)):
        store(root, f"validation_{year}_{month:02d}", document(year, month))
    assert latest_summary(spark, str(root))["artifact_name"] == "validation_2024_06"
    store(root / "artifact_name=validation_2024_07_yellow", "part-0", document(2024, 7))
    assert latest_summary(spark, str(root))["artifact_name"] == "validation_2024_07_yellow"


def test_size_says_nothing_about_soundness(spark, tmp_path):
    rules = {f"rule_{n:06d}": n for n in range(60_000)}
    store(tmp_path, "validation_2024_06", document(2024, 6, rule_counts=rules))
    assert (tmp_path / "validation_2024_06.json").stat().st_size > 1_000_000
    assert latest_summary(spark, str(tmp_path))["rule_counts"] == rules


def test_missing_summaries_are_an_error(spark, tmp_path):
    for folder in (tmp_path / "nowhere", tmp_path):
        with pytest.raises(SummaryError):
            latest_summary(spark, str(folder))


BROKEN = {
    "nothing": {},
    "sum too small": document(2024, 6, total_rows=51),
    "negative": document(2024, 6, valid=-12, warning=6, rejected=6),
    "no such month": document(2024, 6) | {"month": 0},
    "text for a number": document(2024, 6) | {"year": "x"},
    "blank service": document(2024, 6, service="\t "),
    "no time": document(2024, 6, validated_at=""),
    "counts missing": document(2024, 6, status_counts={"warning": 52}),
    "negative rule": document(2024, 6, rule_counts={"duplicate_record": -2}),
    "no rules": document(2024, 6, rule_counts=None),
}


@pytest.mark.parametrize("case", BROKEN)
def test_malformed_summaries_are_refused(spark, tmp_path, case):
    store(tmp_path, "validation_2024_06", BROKEN[case])
    with pytest.raises(SummaryError):
        latest_summary(spark, str(tmp_path))
    assert malformed_summaries(read_summaries(spark, str(tmp_path))).count() == 1
