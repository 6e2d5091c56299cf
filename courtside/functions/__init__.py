from courtside.functions.ordering import earliest_first, latest_first
from courtside.functions import scalars

__all__ = ["earliest_first", "latest_first", "scalars"]
