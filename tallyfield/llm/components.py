"""Connected components, as the catalogue's clusters use them."""

from tallyfield.operators.graph import components

__all__ = ["components"]
