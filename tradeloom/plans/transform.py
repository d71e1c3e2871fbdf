"""Building and publishing the tariff cube from the loaded layers."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tradeloom.operators.store import LayerStore
from tradeloom.plans import datasets as D
from tradeloom.plans import tariff
from tradeloom.plans.ingest import layer

STAGED = "world_bank/tariff/transformed.staged"
PUBLISHED = "world_bank/tariff/transformed"


def transform_tariffs(
    store: LayerStore,
    products: str | None = None,
    resume: bool = False,
    required: DataFrame | None = None,
    first_year: int = tariff.FIRST_YEAR,
    last_year: int = tariff.LAST_YEAR,
) -> DataFrame:
    """Fill the cube and make it the published one; readers see the old cube until the new one is complete.

    ``products`` limits the cube to a list like ``'201,401'``. With ``resume`` the products staged by an
    earlier run are kept and only the others are computed.
    """
    done = store.read(STAGED) if resume and store.exists(STAGED) else None
    cube = tariff.tariff_cube(
        store.read(layer(D.RAW_TARIFF, "L0")),
        store.read(layer(D.BOUND_RATES, "L1")),
        store.read(layer(D.COUNTRY_CODES, "L1")),
        store.read(layer(D.EU_MEMBERSHIP, "L1")),
        required,
        first_year,
        last_year,
        tariff.parse_products(products),
        done,
    )
    # The order in which the cube is stored: files and row groups hold narrow ranges, so reads of a product skip most.
    cube = cube.sortWithinPartitions("product", "reporter", "partner", "year")
    if done is None:
        store.publish(STAGED, cube)
    else:
        store.append(STAGED, cube)
    return store.swap_in(PUBLISHED, STAGED)
