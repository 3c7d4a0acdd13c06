"""All queries; importing the modules registers them."""

from . import columns, exceptions, orders, tables  # noqa: F401
from .registry import QUERIES, SQL  # noqa: F401
