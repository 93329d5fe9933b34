"""Errors raised on the driver; task-side checks raise through ``raise_error``."""

from __future__ import annotations


class ConfigurationError(ValueError):
    """An argument (root, policy, bound, scope) is not usable."""


class ContractError(ValueError):
    """Data breaks a fail-closed rule, so nothing may be acted upon."""
