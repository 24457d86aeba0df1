"""Named query plans over the star-schema tables (see ``registry``)."""

from starloom.plans.registry import ORACLES, QUERIES


def load_all() -> None:
    """Import every plan module so its queries register themselves."""
    from starloom.plans import basic, business, dimensional, integration, loads, relational, resolution, scalar  # noqa: F401
