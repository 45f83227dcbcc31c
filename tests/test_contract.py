from staymill import schema as S
from staymill.operators.tune import expand, sample


def test_columns():
    assert (len(S.NUMERIC), len(S.CATEGORICAL), len(S.FEATURES)) == (15, 11, 26)
    assert not set(S.NUMERIC) & set(S.CATEGORICAL)
    assert not set(S.LEAKAGE_COLUMNS) & set(S.FEATURES)
    assert set(S.EXAMPLE) == set(S.FEATURES) == {c for c, *_ in S.RANGES} | set(S.CATEGORICAL)
    assert set(S.RARE_COLUMNS) <= set(S.CATEGORICAL) and set(S.RARE_NULL_LABELS) == set(S.RARE_COLUMNS)


def test_grids():
    assert {n: len(expand(g)) for n, g in S.GRIDS.items()} == {"Logistic Regression": 8, "Decision Tree": 24, "Random Forest": 54, "Gradient Boosting": 540}
    picked = sample(S.GRIDS["Gradient Boosting"])
    assert len(picked) == 12 == len({str(p) for p in picked}) and picked == sample(S.GRIDS["Gradient Boosting"])
    assert len(sample(S.GRIDS["Logistic Regression"])) == 8
