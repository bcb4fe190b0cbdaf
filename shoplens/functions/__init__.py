"""Column expressions: scalar helpers (``scalar``) and predicates (``filters``)."""

from shoplens.functions import filters, scalar  # noqa: F401
