"""Feature sets: typed configuration that yields the features of a panel."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace


from seriesloom.functions.columns import finite_or_null
from seriesloom.operators import features as ft
from seriesloom.operators.panel import Panel

SPREAD_LAG = 6


@dataclass(frozen=True)
class FeatureSet:
    """Windows per feature kind, for the target and for exogenous columns."""

    target: str
    lags: tuple[int, ...] = ()
    averages: tuple[int, ...] = ()
    sums: tuple[int, ...] = ()
    lag_ratios: tuple[tuple[int, int], ...] = ()
    sum_ratios: tuple[tuple[int, int], ...] = ()
    average_ratios: tuple[tuple[int, int], ...] = ()
    bands: tuple[int, ...] = ()
    strength: tuple[int, ...] = ()
    trailing_max: bool = False
    spreads: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    exog_lags: Mapping[str, tuple[int, ...]] = field(default_factory=dict)
    exog_averages: Mapping[str, tuple[int, ...]] = field(default_factory=dict)
    exog_lag_ratios: Mapping[str, tuple[tuple[int, int], ...]] = field(default_factory=dict)
    exog_to_average: Mapping[str, tuple[int, ...]] = field(default_factory=dict)

    def features(self) -> list[ft.Feature]:
        y = self.target
        out = [ft.lag(y, n) for n in self.lags]
        out += [ft.moving_average(y, n) for n in self.averages]
        out += [ft.moving_sum(y, n) for n in self.sums]
        out += [ft.lag_ratio(y, a, b) for a, b in self.lag_ratios]
        out += [ft.moving_sum_ratio(y, a, b) for a, b in self.sum_ratios]
        out += [ft.moving_average_ratio(y, a, b) for a, b in self.average_ratios]
        out += [ft.band_spread(y, n) for n in self.bands]
        out += [ft.strength_index(y, n) for n in self.strength]
        out += [ft.trailing_max(y)] if self.trailing_max else []
        out += [ft.spread(a, b, SPREAD_LAG, name) for name, (a, b) in self.spreads.items()]
        out += [ft.lag(c, n) for c, ns in self.exog_lags.items() for n in ns]
        out += [ft.moving_average(c, n) for c, ns in self.exog_averages.items() for n in ns]
        out += [ft.lag_ratio(c, a, b) for c, ps in self.exog_lag_ratios.items() for a, b in ps]
        out += [ft.to_moving_average(c, n) for c, ns in self.exog_to_average.items() for n in ns]
        return out

    def memory(self) -> int:
        """How many past target values the target features reach back to."""
        pairs = [n for ps in (self.lag_ratios, self.sum_ratios, self.average_ratios) for p in ps for n in p]
        plain = [*self.lags, *self.averages, *self.sums, *self.bands, *pairs]
        plain += [n + 1 for n in self.strength]
        plain += [ft.TRAILING_MAX_ROWS] if self.trailing_max else []
        return max(plain, default=1)

    def outside(self) -> FeatureSet:
        """Only the features that need more than the target's own past."""
        return FeatureSet(
            target=self.target, spreads=self.spreads, exog_lags=self.exog_lags, exog_averages=self.exog_averages,
            exog_lag_ratios=self.exog_lag_ratios, exog_to_average=self.exog_to_average,
        )

    def inputs(self) -> list[str]:
        """Columns other than the target that features are made of."""
        own = [*self.exog_lags, *self.exog_averages, *self.exog_lag_ratios, *self.exog_to_average]
        own += [c for pair in self.spreads.values() for c in pair]
        return [c for c in dict.fromkeys(own) if c != self.target]

    def outside_memory(self) -> int:
        """How many rows the features of other columns reach back."""
        plain = [n for kind in (self.exog_lags, self.exog_averages, self.exog_to_average) for ns in kind.values() for n in ns]
        plain += [n for ps in self.exog_lag_ratios.values() for p in ps for n in p]
        return max([*plain, *([SPREAD_LAG] if self.spreads else [])], default=1)

    def with_target(self, target: str) -> FeatureSet:
        return replace(self, target=target)


# The set for a target alone.
ENDOGENOUS = FeatureSet(
    target="y", lags=(1, 2), averages=(3, 12), sums=(3,), lag_ratios=((4, 5),), bands=(8, 20)
)


def output_names(fs: FeatureSet) -> list[str]:
    return [n for f in fs.features() for n in f.names]


def build(panel: Panel, fs: FeatureSet, *, fill: str | None = "bfill", leading: bool = False) -> Panel:
    """All features of ``fs`` in one pass, infinities as nulls, inputs kept."""
    p = ft.add_features(panel, fs.features(), fill=fill, leading=leading)
    names = output_names(fs)
    return p.with_df(p.df.withColumns({n: finite_or_null(n) for n in names}))


def features_only(panel: Panel, fs: FeatureSet, **kw) -> Panel:
    """Features and keys without the target and the exogenous inputs."""
    p = build(panel, fs, **kw)
    return p.with_df(p.df.select(*p.series, *p.order, *output_names(fs)))


def lag_pack(panel: Panel, lags: Mapping[str, Sequence[int]], keep: Sequence[str]) -> Panel:
    """A fixed set of exogenous lags, rows with any gap dropped."""
    feats = [ft.lag(c, n) for c, ns in lags.items() for n in ns]
    names = [n for f in feats for n in f.names]
    p = ft.add_features(panel, feats, fill=None)
    return p.with_df(p.df.select(*keep, *names).na.drop(subset=names))


_NAMED = re.compile(r"^(?P<c>.+)_(?P<kind>lag|ma)_(?P<n>\d+)$", re.IGNORECASE)


def from_names(panel: Panel, target: str, names: Sequence[str], **kw) -> Panel:
    """Features spelled as ``<target>_lag_<n>`` and ``<target>_ma_<n>``; other names are ignored."""
    feats, renames = [], {}
    for name in names:
        m = _NAMED.match(name)
        if not m or m["c"].lower() != target.lower():
            continue
        f = (ft.lag if m["kind"].lower() == "lag" else ft.moving_average)(target, int(m["n"]))
        feats.append(f)
        renames[f.names[0]] = name
    p = ft.add_features(panel, feats, **kw)
    return p.with_df(p.df.withColumnsRenamed(renames))
