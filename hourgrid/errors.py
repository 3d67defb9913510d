"""Errors raised when data or parameters break a stated contract."""


class ContractError(ValueError):
    """Data does not meet the contract an operator relies on."""


class ParameterError(ValueError):
    """A query parameter is outside its allowed range."""
