"""Column roles and job settings: which column is the user, the label, the date."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

POSITIVE = 2
NEGATIVE = 1
EXCLUDE = 0


@dataclass(frozen=True)
class Roles:
    """Names of the columns that play a part in the jobs.

    ``row_id`` names a column that tells two rows of the same user, item and day
    apart.  Logs without one can get it from ``operators.ordering.number_copies``.
    """

    user_id: str = "user_id"
    item_id: str = "item_id"
    event_date: str = "filename_date"
    label: str = "is_interacted"
    duration: str = "duration"
    weight: str = "weighted_lr"
    band: str = "popularity_item_group"
    batch: str = "batch_idx"
    row_id: str | None = None
    account_features: tuple[str, ...] = ()
    profile_features: tuple[str, ...] = ()
    item_features: tuple[str, ...] = ()
    context_features: tuple[str, ...] = ("is_weekend",)
    user_context_features: tuple[str, ...] = ()
    item_context_features: tuple[str, ...] = ()

    @property
    def pair(self) -> list[str]:
        return [self.user_id, self.item_id]

    @property
    def user_features(self) -> list[str]:
        return [*self.account_features, *self.profile_features]

    @property
    def model_features(self) -> list[str]:
        """What a model is trained on."""
        return [*self.user_features, *self.item_features, *self.context_features]

    @property
    def all_columns(self) -> list[str]:
        """Every column a job may ask for, in one fixed order."""
        wanted = [
            *self.pair,
            *self.user_features,
            *self.item_features,
            *self.user_context_features,
            *self.item_context_features,
            *self.context_features,
            self.label,
            self.weight,
            self.duration,
        ]
        return list(dict.fromkeys(name for name in wanted if name))

    def select_order(self, requested: Sequence[str] | None = None) -> list[str]:
        """The requested columns that have a role, in role order."""
        if requested is None:
            return self.all_columns
        asked = set(requested)
        return [name for name in self.all_columns if name in asked]


@dataclass(frozen=True)
class Resampling:
    """Fractions of negatives per popularity band.

    ``popular`` bands keep their observed negatives and may gain synthetic ones;
    ``tail`` bands keep only a fraction of theirs; any other band loses them.
    """

    popular: Mapping[int, float] = field(default_factory=dict)
    tail: Mapping[int, float] = field(default_factory=dict)
    seed: str = "resample"

    @property
    def active(self) -> bool:
        """Resampling runs only when some tail band is thinned."""
        return any(fraction != 1 for fraction in self.tail.values())

    @property
    def thins_tail(self) -> bool:
        return len(self.tail) > sum(self.tail.values())

    @property
    def adds_negatives(self) -> bool:
        return sum(self.popular.values()) > 1e-4


@dataclass(frozen=True)
class JobSpec:
    """One model's worth of settings: roles, filters, resampling, report slices."""

    name: str
    roles: Roles
    resampling: Resampling = Resampling()
    batch_size: int = 100_000
    shuffle: bool = True
    train_filters: tuple[str, ...] = ()
    validation_filters: tuple[str, ...] = ()
    metrics: tuple[str, ...] = ("recall_at_k", "precision_at_k", "ndcg_at_k")
    slice_by: tuple[str, ...] = ()
    separate_by: str = ""


def spec_from_mapping(config: Mapping[str, Any]) -> JobSpec:
    """Read the nested settings of a model configuration file."""
    loader = config["data_loader"]
    analysis = config.get("model_analysis") or {}

    def names(key: str) -> tuple[str, ...]:
        return tuple(loader.get(key, ()))

    def fractions(bands: str, factors: str) -> dict[int, float]:
        labels, values = loader.get(bands, ()), loader.get(factors, ())
        if len(labels) != len(values):
            raise ValueError(f"{bands} and {factors} differ in length")
        # bands are compared with an integer column, so type them once, here
        return {int(band): float(value) for band, value in zip(labels, values)}

    roles = Roles(
        user_id=loader["user_id_col"],
        item_id=loader["item_id_col"],
        event_date=loader.get("time_order_event_col") or Roles.event_date,
        label=loader.get("label_col", ""),
        duration=loader.get("duration_col", ""),
        weight=loader.get("weight_col", ""),
        band=loader.get("popularity_item_group_col", ""),
        row_id=loader.get("row_id_col"),
        account_features=names("account_feature_names"),
        profile_features=names("user_feature_names"),
        item_features=names("item_feature_names"),
        context_features=names("context_feature_names"),
        user_context_features=names("user_context_feature_names"),
        item_context_features=names("item_context_feature_names"),
    )
    slices = [
        *analysis.get("by_features", ()),
        *analysis.get("by_external_item_features", ()),
        *analysis.get("by_external_user_features", ()),
    ]
    return JobSpec(
        name=config["config_name"],
        roles=roles,
        resampling=Resampling(
            popular=fractions("popularity_sample_groups", "factor_popularity_sample_groups"),
            tail=fractions("tail_sample_groups", "factor_tail_sample_groups"),
        ),
        batch_size=int(loader.get("batch_size", 0)) or JobSpec.batch_size,
        shuffle=bool(loader.get("shuffle", False)),
        train_filters=names("train_filters"),
        validation_filters=names("validation_filters"),
        metrics=tuple(analysis.get("metrics", JobSpec.metrics)),
        slice_by=tuple(slices),
        separate_by=analysis.get("sep_col", ""),
    )


def load_spec(path: str) -> JobSpec:
    """Read a YAML model configuration."""
    try:
        import yaml
    except ImportError as error:  # pragma: no cover - depends on the image
        raise RuntimeError("reading YAML settings needs the yaml package") from error
    with open(path, encoding="utf-8") as handle:
        return spec_from_mapping(yaml.safe_load(handle))
