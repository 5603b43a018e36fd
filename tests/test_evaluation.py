import pytest

from curbline import schemas
from curbline.config import TIERS
from curbline.plans import evaluation
from curbline.sources import files

# Published agreement of 50 hand-labelled requests: rows human, columns model, least urgent first.
MATRIX = [[15, 2, 0, 0], [8, 6, 6, 0], [1, 4, 6, 0], [0, 0, 2, 0]]


def pairs(spark, matrix):
    data = [(TIERS[i], TIERS[j]) for i, row in enumerate(matrix) for j, n in enumerate(row) for _ in range(n)]
    return spark.createDataFrame(data, "human string, model string")


def test_published_figures(spark):
    p = pairs(spark, MATRIX)
    got = evaluation.agreement(p).head()
    assert got.n == 50 and got.exact_agreement == 0.54 and got.within_one_tier == 0.98
    assert got.cohens_kappa == pytest.approx(0.32, abs=0.005)
    assert got.quadratic_weighted_kappa == pytest.approx(0.64, abs=0.005)
    assert (got.model_more_urgent, got.model_less_urgent) == (8, 15)
    cells = {r.human: [r.low, r.medium, r.high, r.critical] for r in evaluation.confusion(p).collect()}
    assert cells == dict(zip(TIERS, MATRIX))
    tiers = {r.tier: r for r in evaluation.per_tier(p).collect()}
    assert (tiers["Low"].human_count, tiers["Low"].model_count) == (17, 24)
    assert tiers["Low"].precision == 15 / 24 and tiers["Medium"].recall == 0.3
    assert tiers["Critical"].precision is None and tiers["Critical"].recall == 0
    assert evaluation.disagreements(p).count() == 23


def test_kappa_by_hand(spark):
    two = evaluation.agreement(pairs(spark, [[20, 5, 0, 0], [10, 15, 0, 0], [0] * 4, [0] * 4])).head()
    assert two.cohens_kappa == pytest.approx(0.4)
    same = evaluation.agreement(pairs(spark, [[3, 0, 0, 0], [0] * 4, [0] * 4, [0] * 4])).head()
    assert (same.cohens_kappa, same.quadratic_weighted_kappa) == (1.0, 1.0)


def sheet(tmp_path, *labels):
    path = tmp_path / "sheet.csv"
    lines = ["item,service_request_id,service_name,status,address,human_label,notes"]
    lines += [f'{i},R{i},Pothole,open,"1 Main, rear",{label},' for i, label in enumerate(labels)]
    path.write_text("﻿" + "\n".join(lines) + "\n")
    return str(path)


def test_sheet_to_pairs(spark, tmp_path):
    recorded = spark.createDataFrame(
        [tuple([f"R{i}"] + [None] * 9 + ["Low", 0.9, "r", "t", None, None]) for i in range(2)], schemas.ENRICHED)
    rated = files.read_label_sheet(spark, sheet(tmp_path, " HIGH", "low"))
    got = {r.item: (r.human, r.model, r.address) for r in evaluation.pair_labels(rated, recorded).collect()}
    assert got == {0: ("High", "Low", "1 Main, rear"), 1: ("Low", "Low", "1 Main, rear")}
    out = str(tmp_path / "metrics")
    evaluation.write_metrics(evaluation.pair_labels(rated, recorded), out)
    assert spark.read.json(out).head().n == 2
    with pytest.raises(ValueError, match="no human label"):
        files.read_label_sheet(spark, sheet(tmp_path, "High", " "))
    with pytest.raises(ValueError, match="unrecognised"):
        evaluation.pair_labels(files.read_label_sheet(spark, sheet(tmp_path, "Urgent")), recorded)
    with pytest.raises(LookupError):
        evaluation.pair_labels(files.read_label_sheet(spark, sheet(tmp_path, "Low", "Low", "Low")), recorded)


def test_category_agreement(spark):
    labelled = spark.createDataFrame(
        [("a", "Low")] * 2 + [("a", "High")] + [("b", "Low"), ("b", "High"), ("c", "Unknown"), ("d", "Low")],
        "service_name string, urgency_label string")
    kinds = spark.createDataFrame([("a", "Low"), ("b", "Low"), ("c", "Low"), ("e", "Low"), ("d", None)],
                                  "sr_type string, urgency_label string")
    by = evaluation.category_counts(labelled, kinds)
    assert {r.service_name: (r.modal_label, r.modal_matches, r.matching_requests) for r in by.collect()} == {
        "a": ("Low", True, 2), "b": ("High", False, 1)}
    assert tuple(evaluation.category_agreement(by).head()) == (2, 1, 3, 5, 0.6)
