"""Every named query; importing the modules registers them."""

from binledger.registry import campaign, container, pricing  # noqa: F401
from binledger.registry.base import ORACLE, QUERIES  # noqa: F401
