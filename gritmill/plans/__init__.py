"""Steps in order, and the queries; importing the package registers all of them in the catalogue."""

from . import catalogue, connectors, lexicons  # noqa: F401
