"""Decision-support query catalogue, one module per query family."""

from shelfline.plans.catalog import (multichannel, reports, returns_chain, semi_anti, star_topk,  # noqa: F401
                                     subqueries, windows_rollups)
