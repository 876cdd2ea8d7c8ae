"""Validation of payloads that are given: rules, and a language model's opinion, in one call."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerlens.operators import backends, rules

#: What payload files hold that the rules read.
PAYLOAD = (
    "meta struct<seller_name: string, seller_address: string, seller_tax_id: string, buyer_name: string, buyer_address: string, invoice_number: string, issue_date: string, supply_date: string, payment_date: string, "
    "currency: string, total_net: double, total_vat: double, total_gross: double, vat_exemption_reason: string>, "
    "rows array<struct<description: string, quantity: double, unit_price: double, net_amount: double, vat_rate: double, vat_amount: double, gross_amount: double, currency: string>>"
)


def run(payloads: DataFrame, checks: rules.Rules = rules.Rules(), llm: backends.Validator | None = None) -> DataFrame:
    """payloads (doc_id, meta, rows) with `validation` and `llm`."""
    return (llm or backends.StubValidator()).validate(rules.validate(payloads, checks))
