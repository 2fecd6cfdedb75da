"""aerolytics — keyed hourly time-series analytics expressed as Spark DataFrame operators.

Every operator is ``DataFrame -> DataFrame`` with the key, time and value column names
as parameters, so operators chain with ``df.transform(...)`` and stay lazy; Catalyst
plans, prunes and pushes down the whole chain.
"""

from aerolytics.session import get_session

__all__ = ["get_session"]
