"""All registered queries; importing this package fills ``registry.QUERIES``."""

from tallyworks.plans import (aggregates, exchange, filters, joins, learning, preparation, ranking,  # noqa: F401
                              scalars, traffic)
