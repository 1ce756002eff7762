"""A list of preprocessing steps that is built up, checked and replayed.

A step is a dictionary ``{"id", "op_type", "params"}``. Adding one applies it to the current data; it stays in the list
only if it succeeds. Replaying folds the list over the initial frame.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable
from copy import deepcopy
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from quern.frames import Data, Outcome, Splits, all_numeric, apply_to, string_columns, training
from quern.operators import columns, duplicates, encode, missing, outliers, power, scale, split, types
from quern.operators import reduce as reduction
from quern.staging import staged


@dataclass(frozen=True)
class State:
    """What earlier steps have done, as far as later ones ask."""

    encoded: bool = False
    scaler: str | None = None
    reduced: bool = False

    def after(self, step: dict) -> State:
        kind, params = step["op_type"], step["params"]
        return State(
            self.encoded or kind == "encode_columns",
            params["scaling_method"] if kind == "scale_columns" else self.scaler,
            self.reduced or kind == "pca",
        )


def _done(data: Data, message: str, details: dict | None = None) -> Outcome:
    return Outcome("success", message, data, details)


def _rename(data: Data, p: dict) -> Outcome:
    if p["old_name"] not in training(data).columns:
        return _done(data, f"no column {p['old_name']}")
    renamed = columns.rename_column(data, p["old_name"], p["new_name"])
    return _done(renamed, f"{p['old_name']} renamed to {p['new_name']}")


def _duplicates(data: Data, p: dict) -> Outcome:
    remove = duplicates.drop_duplicates if p["keep_first"] else duplicates.drop_all_duplicated
    return _done(remove(data), "duplicate rows removed")


def _drop(data: Data, p: dict) -> Outcome:
    return _done(columns.drop_columns(data, p["columns"]), f"dropped {p['columns']}")


def _missing(data: Data, p: dict) -> Outcome:
    strategy = p["fill_strategy"]
    affected = p.get("cols_with_na")
    fills = {
        "Fill with Mean": missing.fill_mean,
        "Fill with Median": missing.fill_median,
        "Fill with Mode": missing.fill_mode,
    }
    if strategy == "Drop":
        change = missing.drop_columns_with_missing if p.get("axis") == 1 else missing.drop_rows
        return _done(change(data), "missing values dropped")
    if strategy == "Fill with Custom Value":
        return _done(missing.fill_custom(data, p["custom_value"]), f"filled with {p['custom_value']!r}")
    chosen = missing.columns_with_missing(data) if affected is None else affected
    return _done(fills[strategy](data, chosen), strategy)


def _convert(data: Data, p: dict) -> Outcome:
    return types.convert(data, p["selected_column"], p["selected_datatype"])


_SPLIT_PARAMS = (
    "test_size", "random_state", "shuffle", "stratify_col", "stratify_num_bins", "order_by", "columns",
)


def _split_two(data: Data, p: dict) -> Outcome:
    return _done(split.train_test_split(data, **{k: p[k] for k in _SPLIT_PARAMS if k in p}), "split in two")


def _split_three(data: Data, p: dict) -> Outcome:
    known = (*_SPLIT_PARAMS, "validation_size")
    return _done(split.train_test_val_split(data, **{k: p[k] for k in known if k in p}), "split in three")


def _outliers(data: Data, p: dict) -> Outcome:
    method, column = p["outlier_removal_method"], p["selected_outlier_column"]
    limits = (p["bottom_percentage"], p["top_percentage"]) if method == "Percentage" else ()
    return _done(outliers.REMOVERS[method](data, column, *limits), f"outliers of {column} removed by {method}")


def _scale(data: Data, p: dict) -> Outcome:
    return _done(scale.scale(data, p["scaling_method"]), f"scaled by {p['scaling_method']}")


def _encode(data: Data, p: dict) -> Outcome:
    chosen = p.get("cat_cols") if isinstance(data, Splits) else None
    if not [c for c in string_columns(training(data)) if chosen is None or c in chosen]:
        return Outcome("warning", "no text columns to encode", data)
    encoded = encode.encode(data, p["encoding_method"], chosen, p.get("target_column"))
    return _done(encoded, f"{p['encoding_method']} applied")


def _transform(data: Data, p: dict) -> Outcome:
    return power.transform(data, p["col_to_transform"], p["transform_method"])


def _variance(data: Data, p: dict) -> Outcome:
    return _done(reduction.variance_threshold(data, float(p["threshold"])), "columns of low variance removed")


def _pca(data: Data, p: dict) -> Outcome:
    scaler = None if p.get("is_data_scaled") else p.get("selected_scaler") or "StandardScaler (Z-score)"
    reduced, fitted = reduction.pca(data, p.get("n_components"), scaler)
    shares = {"ratio": fitted.explained, "cumulative": fitted.cumulative()}
    return _done(reduced, f"reduced to {len(fitted.explained)} components", shares)


def _best(data: Data, p: dict) -> Outcome:
    if isinstance(data, Splits):
        return Outcome("error", "features are selected before the split", data)
    chosen = reduction.select_best(data, p["target_col"], p["k"])
    return _done(chosen, f"kept {chosen.columns}")


# Names of the steps.
STEPS: dict[str, Callable[[Data, dict], Outcome]] = {
    "rename_column": _rename,
    "remove_duplicates": _duplicates,
    "drop_columns": _drop,
    "missing_values": _missing,
    "datatype_convertion": _convert,
    "train_test_split": _split_two,
    "train_test_val_split": _split_three,
    "remove_outliers": _outliers,
    "scale_columns": _scale,
    "encode_columns": _encode,
    "transform_columns": _transform,
    "variance_threshold": _variance,
    "pca": _pca,
    "feature_selection": _best,
}

NEEDS_COMPLETE = {
    "datatype_convertion", "remove_outliers", "train_test_split", "train_test_val_split", "transform_columns",
    "encode_columns",
}
BEFORE_ENCODING = {"remove_outliers", "transform_columns"}
BEFORE_SPLIT = {"remove_duplicates", "missing_values", "train_test_split", "train_test_val_split"}


def objection(data: Data, step: dict, state: State) -> str | None:
    """Why a step must not be taken now, or None."""
    kind = step["op_type"]
    if kind in BEFORE_SPLIT and isinstance(data, Splits):
        return f"{kind} is not possible after the data have been split"
    if kind in BEFORE_ENCODING and state.encoded:
        return f"{kind} is not possible after encoding"
    if kind == "scale_columns" and state.scaler:
        return "the data are scaled already"
    if kind == "pca":
        if state.reduced:
            return "principal components have been taken already"
        if not all_numeric(training(data)):
            return "principal components need numeric columns only"
    if kind in NEEDS_COMPLETE and missing.columns_with_missing(training(data)):
        return f"{kind} is not possible with missing values"
    return None


def apply_step(data: Data, step: dict) -> Outcome:
    """Apply one step without asking for preconditions; whatever goes wrong leaves the data as they are."""
    act = STEPS.get(step["op_type"])
    if act is None:
        return Outcome("warning", f"unknown operation: {step['op_type']}", data)
    try:
        return act(data, step["params"])
    except (ValueError, LookupError, TypeError, AttributeError) as error:
        return Outcome("error", f"{step['op_type']}: {error}", data)


#: Steps that shuffle their input or run Python on it. Their results are written out, so that later fits do not repeat them.
COSTLY = {"remove_duplicates", "encode_columns"}


def costly(step: dict) -> bool:
    """Whether a step's result is written out unless the step says otherwise."""
    forest = step["params"].get("outlier_removal_method") == "Isolation Forest"
    return step.get("stage", step["op_type"] in COSTLY or forest)


@dataclass
class Recipe:
    """Steps and the data they make of a frame.

    What each step made, fitted parameters included, is remembered under the steps up to it. So replaying the list on the
    initial frame fits nothing again, and after an edit only the steps from there on are fitted. Another frame is fitted
    from the start. ``forget`` drops what is remembered, as is needed when the files of the initial frame have changed.
    """

    initial: DataFrame
    steps: list[dict] = field(default_factory=list)
    checked: bool = True

    def __post_init__(self) -> None:
        self._known: dict[str, tuple[Outcome, Data, State]] = {}
        self._current, self._state, self.outcomes = self.replayed(self.initial)

    @property
    def current(self) -> Data:
        return self._current

    def add(self, op_type: str, params: dict, stage: bool | None = None) -> Outcome:
        """Take one step. ``stage`` says whether its result is written out; else costly steps' results are."""
        step = {"id": str(uuid.uuid4()), "op_type": op_type, "params": deepcopy(params)}
        if stage is not None:
            step["stage"] = stage
        refused = objection(self._current, step, self._state) if self.checked else None
        if refused:
            return Outcome("warning", refused, self._current)
        outcome, data, state = self._taken(self._name(self.steps + [step]), self._current, self._state, step)
        if outcome.ok:
            self.steps.append(step)
            self._current, self._state = data, state
            self.outcomes.append(outcome)
        return Outcome(outcome.status, outcome.message, self._current, outcome.details)

    def change(self, place: int, params: dict | None) -> Data:
        """Give the step at ``place`` other parameters, or take it out (None); steps before it are not fitted again."""
        if params is None:
            del self.steps[place]
        else:
            self.steps[place] = {**self.steps[place], "params": deepcopy(params)}
        self._current, self._state, self.outcomes = self.replayed(self.initial)
        return self._current

    def forget(self) -> None:
        self._known.clear()

    @property
    def left_out(self) -> list[tuple[dict, str]]:
        """Steps that did not succeed when the list was last applied, and why."""
        return [(step, o.message) for step, o in zip(self.steps, self.outcomes, strict=True) if not o.ok]

    @staticmethod
    def _name(steps: list[dict]) -> str:
        """What the steps do to a frame, whatever their ids."""
        told = [(s["op_type"], s["params"], costly(s)) for s in steps]
        return hashlib.sha256(json.dumps(told, sort_keys=True, default=repr).encode()).hexdigest()

    def _taken(self, name: str, data: Data, state: State, step: dict) -> tuple[Outcome, Data, State]:
        """What a step makes of the data, remembered if it succeeds; a step that fails leaves them as they are."""
        if name not in self._known:
            outcome = apply_step(data, step)
            if not outcome.ok:
                return outcome, data, state
            made = apply_to(outcome.data, staged) if costly(step) else outcome.data
            self._known[name] = Outcome(outcome.status, outcome.message, made, outcome.details), made, state.after(step)
        return self._known[name]

    def replayed(self, initial: DataFrame) -> tuple[Data, State, list[Outcome]]:
        """The list applied anew: the result, the state that the successful steps make, and what became of each."""
        apply = self._taken if initial is self.initial else Recipe(initial)._taken
        data, state, outcomes = initial, State(), []
        for place, step in enumerate(self.steps, 1):
            outcome, data, state = apply(self._name(self.steps[:place]), data, state, step)
            outcomes.append(outcome)
        return data, state, outcomes

    def replay(self, initial: DataFrame | None = None) -> Data:
        """The list applied anew, to the initial frame or to another one of the same shape; see ``left_out``."""
        data, _, self.outcomes = self.replayed(self.initial if initial is None else initial)
        return data
