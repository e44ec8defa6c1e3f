"""Errors raised before a DataFrame is returned."""


class NotFound(LookupError):
    """The named series has no rows."""


class NotReady(RuntimeError):
    """A table the query reads has not been built yet."""


class LimitExceeded(ValueError):
    """More rows were asked for than the query allows."""
