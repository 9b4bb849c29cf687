"""Errors raised before anything is written."""


class DataContractError(ValueError):
    """Input data or parameters break a stated contract."""


class MissingColumns(DataContractError):
    """A source lacks columns an operator needs."""


class PublishRefused(DataContractError):
    """A check failed, so nothing was published."""


class PublishConflict(PublishRefused):
    """Another writer published the table first."""
