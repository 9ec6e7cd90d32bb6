"""Versioned rate cards: validation, exact lookups for one payment, and lookups as joins.

A rate is looked up as of the settlement date: by merchant and instrument, else by instrument, else
the card's default. In DataFrames the rates are small tables joined by key, so the size of an
expression does not grow with the number of merchants.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date
from pathlib import Path

import yaml
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import INSTRUMENTS
from .dates import iso
from .money import bps_amount, bps_amount_scalar, gst_pct_to_bps
from .tables import local_table

DEFAULT_FILE = Path(__file__).parent.parent / "config" / "fee_rates.yaml"
#: Names under which a file may keep its card history.
HISTORY_NAMES = ("history", "rate_history", "rate_cards")
MOST_TOLERANCE = 100


class RateError(ValueError):
    """A rate file that must not be used."""


@dataclass(frozen=True)
class Rate:
    mdr_bps: int
    gst_bps: int
    tolerance: int


@dataclass
class Card:
    version: str
    start: str
    end: str | None
    default: Rate
    instruments: dict[str, Rate]
    merchants: dict[tuple[str, str], Rate]
    own_merchants: set[str] = field(default_factory=set)


def _whole(value, low: int, high: int, what: str) -> int:
    if isinstance(value, bool) or not isinstance(value, int) or not low <= value <= high:
        raise RateError(f"{what} must be a whole number from {low} to {high}, not {value!r}")
    return value


def _rate(spec: dict, base: Rate | None, what: str) -> Rate:
    if not isinstance(spec, dict):
        raise RateError(f"{what} must be a mapping")
    mdr = _whole(spec["mdr_rate_bps"], 0, 10_000, f"{what}: mdr_rate_bps") if "mdr_rate_bps" in spec else base and base.mdr_bps
    if "gst_on_mdr" in spec:
        pct = spec["gst_on_mdr"]
        if isinstance(pct, bool) or not isinstance(pct, (int, float)) or not 0 <= pct <= 100:
            raise RateError(f"{what}: gst_on_mdr must be a percentage, not {pct!r}")
        gst = gst_pct_to_bps(pct)
    else:
        gst = base and base.gst_bps
    tol = _whole(spec["tolerance_paise"], 0, MOST_TOLERANCE, f"{what}: tolerance_paise") if "tolerance_paise" in spec else base and base.tolerance
    if mdr is None or gst is None:
        raise RateError(f"{what} lacks mdr_rate_bps or gst_on_mdr")
    return Rate(mdr, gst, 1 if tol is None else tol)


def _day(value, what: str) -> str:
    try:
        return date.fromisoformat(str(value)).isoformat()
    except ValueError as e:
        raise RateError(f"{what} must be an ISO date, not {value!r}") from e


class RateBook:
    """All cards of one configuration, oldest first."""

    def __init__(self, config: dict):
        if not isinstance(config, dict) or "default" not in config:
            raise RateError("a rate file needs a default rate")
        self.config, self.cards = config, self._cards(config)

    @classmethod
    def load(cls, path: str | Path | None = None) -> RateBook:
        with open(path or DEFAULT_FILE, encoding="utf-8") as f:
            return cls(yaml.safe_load(f))

    @staticmethod
    def _cards(config: dict) -> list[Card]:
        history = next((config[n] for n in HISTORY_NAMES if config.get(n)), None) or [{"version": config.get("version", "v0"), "effective_from": "1970-01-01"}]
        cards = []
        for spec in history:
            version = str(spec.get("version", "?"))
            start = _day(spec.get("effective_from"), f"{version}: effective_from")
            end = _day(spec["effective_to"], f"{version}: effective_to") if spec.get("effective_to") else None
            if end and end < start:
                raise RateError(f"{version} ends before it starts")
            default = _rate(spec.get("default", config["default"]), None, f"{version}: default")
            instruments = {}
            for name, r in (spec.get("instruments") or config.get("instruments") or {}).items():
                if name not in INSTRUMENTS:
                    raise RateError(f"{version}: unknown instrument {name!r}")
                instruments[name] = _rate(r, default, f"{version}: {name}")
            merchants, own = {}, set()
            for level, table in ((0, config.get("merchants") or {}), (1, spec.get("merchants") or {})):
                for who, by in table.items():  # a card's own entries replace the general ones
                    if level:
                        own.add(who)
                    for name, r in by.items():
                        if name not in INSTRUMENTS:
                            raise RateError(f"{version}: {who}: unknown instrument {name!r}")
                        merchants[who, name] = _rate(r, default, f"{version}: {who}: {name}")
            cards.append(Card(version, start, end, default, instruments, merchants, own if spec.get("merchants") is not None else set(config.get("merchants") or {})))
        cards.sort(key=lambda c: c.start)
        for a, b in zip(cards, cards[1:]):
            if a.end is None or a.end >= b.start:
                raise RateError(f"{a.version} and {b.version} overlap; only the last card may be open")
        return cards

    # one payment at a time

    def card(self, day: str | None) -> Card:
        """No date or no calendar date: the newest card; before all: the oldest; in a gap: the one before."""
        try:
            if day is None or len(day) != 10:
                raise ValueError
            date.fromisoformat(day)
        except (ValueError, TypeError):
            return self.cards[-1]
        return next((c for c in reversed(self.cards) if day >= c.start), self.cards[0])

    def rate(self, instrument: str | None, merchant: str | None = None, day: str | None = None) -> Rate:
        c = self.card(day)
        return c.merchants.get((merchant, instrument)) or c.instruments.get(instrument) or c.default

    def fee(self, amount: int, instrument: str | None, merchant: str | None = None, day: str | None = None) -> tuple[int, int, int]:
        """(fee, GST on the fee, net) of one payment; a negative amount is refused."""
        if amount < 0:
            raise ValueError("an amount must not be negative")
        r = self.rate(instrument, merchant, day)
        fee = bps_amount_scalar(amount, r.mdr_bps)
        gst = bps_amount_scalar(fee, r.gst_bps)
        return fee, gst, amount - fee - gst

    def expected_settled(self, amount: int, instrument: str | None, merchant: str | None = None, day: str | None = None) -> int:
        return self.fee(amount, instrument, merchant, day)[2]

    def matches(self, amount: int, settled: int, instrument: str | None, merchant: str | None = None, day: str | None = None) -> bool:
        return abs(self.expected_settled(amount, instrument, merchant, day) - settled) <= self.rate(instrument, merchant, day).tolerance

    @property
    def default(self) -> Rate:
        return self.cards[-1].default

    # columns

    def card_index(self, day: Column) -> Column:
        out = F.when(iso(day).isNull(), F.lit(len(self.cards) - 1))
        for i in range(len(self.cards) - 1, 0, -1):
            out = out.when(day >= self.cards[i].start, F.lit(i))
        return out.otherwise(F.lit(0))

    def card_version(self, day: Column) -> Column:
        return F.element_at(F.array(*(F.lit(c.version) for c in self.cards)), self.card_index(day) + 1)

    def with_rates(self, df: DataFrame, instrument: str, merchant: str | None, day: str, prefix: str = "rate_") -> DataFrame:
        """df with <prefix>mdr, <prefix>gst and <prefix>tol; merchant None prices without merchants.

        The rate tables are local relations of known size: Spark broadcasts them while they are small and
        joins them by key otherwise. A null merchant matches none.
        """
        spark, names = df.sparkSession, ("mdr", "gst", "tol")
        at, card = lambda t: f"_{prefix}{t}", f"_{prefix}card"
        row = lambda r: (r.mdr_bps, r.gst_bps, r.tolerance)
        out = df.withColumn(card, self.card_index(F.col(day)))
        rates = [F.array(*(F.lit(row(c.default)[i]) for c in self.cards)) for i in range(3)]
        found = [F.element_at(r, F.col(card) + 1) for r in rates]
        by_inst = [(i, n, *row(r)) for i, c in enumerate(self.cards) for n, r in c.instruments.items()]
        if by_inst:
            t = local_table(spark, by_inst, f"{at('c')} int, {at('i')} string, {at('i_mdr')} int, {at('i_gst')} int, {at('i_tol')} int")
            out = out.join(t, (F.col(card) == F.col(at("c"))) & (F.col(instrument) == F.col(at("i"))), "left")
            found = [F.coalesce(F.col(at(f"i_{n}")), f) for n, f in zip(names, found)]
        by_merch = [(i, m, n, *row(r)) for i, c in enumerate(self.cards) for (m, n), r in c.merchants.items()] if merchant else []
        if by_merch:
            t = local_table(spark, by_merch, f"{at('mc')} int, {at('mm')} string, {at('mi')} string, {at('m_mdr')} int, {at('m_gst')} int, {at('m_tol')} int")
            out = out.join(t, (F.col(card) == F.col(at("mc"))) & (F.col(merchant) == F.col(at("mm"))) & (F.col(instrument) == F.col(at("mi"))), "left")
            found = [F.coalesce(F.col(at(f"m_{n}")), f) for n, f in zip(names, found)]
        return out.select(*(F.col(c) for c in df.columns), *(f.alias(f"{prefix}{n}") for n, f in zip(names, found)))

    def with_net(self, df: DataFrame, amount: str, instrument: str, merchant: str | None, day: str, prefix: str = "rate_") -> DataFrame:
        """df with the rates and <prefix>fee, <prefix>fee_gst and <prefix>net of amount."""
        out = self.with_rates(df, instrument, merchant, day, prefix)
        out = out.withColumn(f"{prefix}fee", bps_amount(F.col(amount), F.col(f"{prefix}mdr")))
        out = out.withColumn(f"{prefix}fee_gst", bps_amount(F.col(f"{prefix}fee"), F.col(f"{prefix}gst")))
        return out.withColumn(f"{prefix}net", F.col(amount) - F.col(f"{prefix}fee") - F.col(f"{prefix}fee_gst"))

    def with_reason(self, df: DataFrame, merchant: str, instrument: str, day: str, reason: str = "reason") -> DataFrame:
        """df with why a row's rate is a fallback: the first reason only, null when it is none. The merchants with rates are a table to join, not an expression."""
        known = sorted({m for c in self.cards for m in c.own_merchants})
        own = local_table(df.sparkSession, [(m,) for m in known] or [(None,)], "_own string")
        named = F.col(merchant).isNotNull() & (F.col(merchant) != "UNKNOWN")
        why = (
            F.when(iso(F.col(day)).isNull(), "card_unparseable_date")
            .when(F.col(day) < self.cards[0].start, "card_out_of_range")
            .when(named & F.col("_own").isNull(), "merchant_unknown")
            .when(F.col(instrument).isNull() | ~F.col(instrument).isin(INSTRUMENTS), "instrument_unknown")
        )
        return df.join(own, F.col(merchant) == F.col("_own"), "left").select(*[F.col(c) for c in df.columns], why.alias(reason))


REASONS = ["card_unparseable_date", "card_out_of_range", "merchant_unknown", "instrument_unknown"]


@dataclass(frozen=True)
class Providers:
    """Lag and late limits by provider."""

    config: dict

    @classmethod
    def load(cls, path: str | Path | None = None) -> Providers:
        with open(path or DEFAULT_FILE.parent / "providers.yaml", encoding="utf-8") as f:
            config = yaml.safe_load(f)
        if not isinstance(config, dict) or "providers" not in config:
            raise ValueError("a provider file needs providers")
        return cls(config)

    def spec(self, provider: str | None) -> dict:
        return {"lag_days": 2, "late_sla_days": 7} | dict(self.config.get("default") or {}) | dict((self.config.get("providers") or {}).get(provider) or {})

    def lag(self, provider: Column) -> Column:
        names = list(self.config.get("providers") or {})
        known = F.create_map(*(F.lit(x) for n in names for x in (n, int(self.spec(n)["lag_days"])))) if names else None
        default = F.lit(int(self.spec(None)["lag_days"]))
        return default if known is None else F.coalesce(F.when(provider.isNotNull(), F.try_element_at(known, provider)), default)

    @staticmethod
    def batch_id(provider: Column, day: Column) -> Column:
        return F.concat(F.coalesce(provider, F.lit("gateway")), F.lit(":"), day)
