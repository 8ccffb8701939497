"""Every operator applied to the whole driver tables, each with the SQL that must agree.

A plan maps a name to ``(run, sql)``; ``sql`` is ``None`` where SQL cannot say the same.
"""

from rushcart.plans import cache, latency, purchases, recommend, streams, traffic, versions

PLANS = {
    **purchases.PLANS,
    **traffic.PLANS,
    **latency.PLANS,
    **versions.PLANS,
    **cache.PLANS,
    **recommend.PLANS,
    **streams.PLANS,
}
