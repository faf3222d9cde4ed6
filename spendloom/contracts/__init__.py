"""Typed table contracts: column order, types and text lengths."""

from spendloom.contracts.contract import Checked, Contract, Field, day, flag, moment, money, number, rate, text, whole

__all__ = ["Checked", "Contract", "Field", "day", "flag", "moment", "money", "number", "rate", "text", "whole"]
