"""landfall: land raw records as flat tables with Spark, and prove they landed."""

from landfall.contract import Contract, ContractError, Resource, RunWindow, run_window

__all__ = ["Contract", "ContractError", "Resource", "RunWindow", "run_window"]
