"""Argument checks of the serving queries (Q9)."""

import pytest

from clickforge.plans import serving as S


def test_limit_is_honoured_or_rejected():
    assert S.check_limit(999) == 999
    assert S.check_limit("20") == 20
    assert S.check_limit(None) is None
    with pytest.raises(S.BadRequest):
        S.check_limit(0)
    with pytest.raises(S.BadRequest):
        S.check_limit("abc")


def test_metric_date_device_z():
    assert S.check_metric("bounce_rate") == "bounce_rate"
    with pytest.raises(S.BadRequest):
        S.check_metric("clicks")
    assert S.check_date("2024-01-15") == "2024-01-15"
    assert S.check_date(None) is None
    with pytest.raises(S.BadRequest):
        S.check_date("15/01/2024")
    assert S.check_device("MOBILE") == "mobile"
    with pytest.raises(S.BadRequest):
        S.check_device("smartwatch")
    assert S.check_zscore("2.5") == 2.5
    with pytest.raises(S.BadRequest):
        S.check_zscore("high")
