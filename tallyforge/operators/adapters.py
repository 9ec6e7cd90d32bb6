"""Provider files to the canonical settlement columns."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import iso_text
from ..functions.money import minor_units
from ..functions.text import currency, instrument, merchant, present
from ..schemas import SETTLEMENT


def plain_name(name: str) -> str:
    """A header in lower case with one underscore for spaces and dashes."""
    return re.sub(r"[\s-]+", "_", name.strip().lower())


@dataclass(frozen=True)
class Provider:
    """Where a provider keeps each canonical column (candidates in order), and how its files are told."""

    name: str
    signature: frozenset[str]
    absent: frozenset[str] = frozenset()
    transaction: tuple[str, ...] = ("payment_id",)
    settlement: tuple[str, ...] = ("settlement_id",)
    reference: tuple[str, ...] = ("utr", "settlement_utr")
    reference_is_settlement: bool = True
    settled: tuple[str, ...] = ("settlement_amount",)
    gross: tuple[str, ...] = ("amount",)
    fee: tuple[str, ...] = ("fee",)
    gst: tuple[str, ...] = ("tax",)
    day: tuple[str, ...] = ("settlement_date",)
    method: tuple[str, ...] = ("payment_method",)
    minor: bool = False

    def handles(self, headers: list[str]) -> bool:
        """Detection reads headers in lower case only; spaces stay."""
        have = {h.strip().lower() for h in headers}
        return self.signature <= have and not self.absent & have


# Header signatures and column names of the known providers, in order of detection.
PROVIDERS = [
    Provider("razorpay", frozenset({"payment id", "settlement id"}), reference=("settlement_utr",), reference_is_settlement=False),
    Provider("cashfree", frozenset({"payment_id", "settlement_id", "settlement_amount"}), frozenset({"settlement utr"})),
    Provider("payu", frozenset({"mihpayid"}), transaction=("mihpayid", "transaction_id", "txnid", "txnid_"), settlement=("settlementid", "settlement_id"), settled=("settlementamount", "settlement_amount"), gross=("amount", "gross_amount"), fee=("surcharge", "fee"), day=("settlementdate", "settlement_date"), method=("paymentmode", "payment_mode", "paymentmethod", "payment_method")),
    Provider("generic", frozenset({"transaction_id", "bank_ref_id", "settled_amount_paise"}), transaction=("transaction_id",), reference=("bank_ref_id",), reference_is_settlement=False, settled=("settled_amount_paise",), gross=("gross_amount_paise",), fee=("fee_paise",), gst=("gst_paise",), method=("instrument_type",), minor=True),
]
BY_NAME = {p.name: p for p in PROVIDERS}


def detect(headers: list[str], hint: str | None = None) -> Provider:
    if hint and hint.strip().lower() in BY_NAME:
        return BY_NAME[hint.strip().lower()]
    return next((p for p in PROVIDERS if p.handles(headers)), BY_NAME["generic"])


def normalise(raw: DataFrame, hint: str | None = None) -> DataFrame:
    """The canonical rows of one provider file; every column is a projection, nothing is shuffled."""
    p = detect(raw.columns, hint)
    names = [plain_name(c) for c in raw.columns]
    df = raw.toDF(*(n if names.index(n) == i else f"{n}_{i}" for i, n in enumerate(names)))
    here = set(names)
    pick = lambda cands: next((F.col(c) for c in cands if c in here), F.lit(None).cast("string"))
    first = lambda cands: F.coalesce(*(present(F.col(c)) for c in cands if c in here), F.lit(None).cast("string"))
    money = lambda cands: pick(cands).try_cast("decimal(38,0)").cast("long") if p.minor else minor_units(pick(cands))
    settlement = first(p.settlement)
    reference: Column = present(pick(p.reference))
    if p.reference_is_settlement and not here & set(p.reference):
        reference = settlement
    days = [iso_text(F.col(c)) for c in (*p.day, *(() if p.minor else ("created_at",))) if c in here]
    merchants = next((F.col(c) for c in ("merchant_id", "account_id") if c in here), F.lit(None).cast("string"))
    own_provider = F.col("provider") if "provider" in here else F.lit(p.name)
    utr = present(F.col("utr")) if p.minor and "utr" in here else reference
    values = {
        "bank_ref_id": reference, "transaction_id": first(p.transaction), "settled_amount_paise": money(p.settled),
        "settlement_date": F.coalesce(*days, F.lit(None).cast("string")), "instrument_type": instrument(pick(p.method)), "merchant_id": merchant(merchants),
        "fee_paise": money(p.fee), "gst_paise": money(p.gst), "settlement_id": settlement, "utr": utr, "currency": currency(pick(("currency",))),
        "gross_amount_paise": money(p.gross), "provider": own_provider,
    }
    return df.select(*(values[f.name].cast(f.dataType).alias(f.name) for f in SETTLEMENT.fields))
