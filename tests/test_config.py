import pytest

from seriesmill.config import CATEGORY_NAMES, ForecastConfig, RoleError, resolve_role


def test_exact_beats_case_insensitive():
    assert resolve_role(["TITLE", "title"], "title", (), "Category") == "title"
    assert resolve_role(["TITLE"], "title", (), "Category") == "TITLE"


def test_candidates_in_priority_order():
    assert resolve_role(["MaterialType", "Collection"], None, CATEGORY_NAMES, "Category") == "Collection"
    assert resolve_role(["FORMAT"], None, CATEGORY_NAMES, "Category") == "FORMAT"
    assert resolve_role(["x"], None, CATEGORY_NAMES, "Category") is None


def test_unknown_name_gives_hint_and_columns():
    with pytest.raises(RoleError, match=r"similar: checkoutyear\).*has checkoutyear, title"):
        resolve_role(["checkoutyear", "title"], "checkoutyer", (), "Year")


def test_long_column_list_is_cut():
    with pytest.raises(RoleError, match="c24 and 5 others"):
        resolve_role([f"c{i}" for i in range(30)], "zzz", (), "Year")


def test_date_column_wins_over_parts():
    columns = ["Date", "Year", "Month", "Collection", "MaterialType", "Checkouts"]
    roles = ForecastConfig().roles(columns)
    assert (roles.date, roles.year, roles.count, roles.material) == ("Date", None, "Checkouts", "MaterialType")
    roles = ForecastConfig(only_material=None).roles(columns[1:])
    assert (roles.date, roles.year, roles.month, roles.material) == (None, "Year", "Month", None)


def test_missing_roles_are_errors():
    for columns in (["Date", "Collection"], ["MaterialType", "Collection", "Year"]):
        with pytest.raises(RoleError):
            ForecastConfig().roles(columns)
