"""The registered queries, one module per group of operators."""

from importlib import import_module

from tabloom.catalog.base import QUERIES, SQL

MODULES = (
    "s_sources", "p_projections", "j_joins", "a_aggregates", "w_windows", "f_functions", "g_profiles",
    "e_encodings", "i_preparation", "m_models", "q_metrics", "t_series", "l_plans",
)


def _load() -> None:
    for name in MODULES:
        import_module(f"tabloom.catalog.{name}")


def queries():
    _load()
    return QUERIES


def oracle_sql():
    _load()
    return SQL
