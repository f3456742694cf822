"""Whole transfers."""

from transferkit.plans.transfer import TransferResult, incremental_transfer, transfer

__all__ = ["TransferResult", "incremental_transfer", "transfer"]
