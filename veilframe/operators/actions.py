"""Header actions compiled to projections, in wide and in tall form.

Actions run in recipe order. Wide, a field's expression is composed in place, and a
new projection starts only before a value that reads other fields (a function), so that
it sees the values as they are by then. Tall, one pass over a record's elements finds
which steps of the recipe select which element (selectors read identities, which no
action changes), kept as bits in an array beside the elements; each step is then one
cheap transform that tests a bit.
Actions of one kind in a row that carry no value are one step. No action shuffles.

A function, predicate or literal is given the element's own keyword, tag, VR and name in
both forms. What a function reads of the record is bound once per record and projection,
never inside the loop over elements: a digest per element would cost more than all else.

Rules that hold whatever the order: KEEP guards its fields from all but ADD, fields
that a REPLACE or JITTER selects are not removed, and protected keywords are never
selected. Sequences and private fields, where they are to go, go first.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import tags
from ..functions import values as V
from .recipe import Action, Recipe, Rule
from .selectors import PROTECTED, Field, Keyed, Selector, any_of, let, value_matches

#: A function of a recipe: (value, field, getter of other fields, extras) -> Column.
#: In tall form the attributes of field are columns of the element.
Function = Callable[[Column, Field, Callable[[str], Column], dict], Column]


@dataclass
class Engine:
    """A recipe with what its values refer to.

    variables: name -> column of the input (the replacement ids of a record).
    functions: more functions for `func:`; predicates for REMOVE give booleans.
    remove_private, strip_sequences: whether private fields, and sequences with all below them, go before any action.
    disable_skip: let selectors reach the protected keywords.
    """

    recipe: Recipe
    salt: str = ""
    variables: dict[str, str] = field(default_factory=dict)
    functions: dict[str, Function] = field(default_factory=dict)
    remove_private: bool = False
    strip_sequences: bool = False
    disable_skip: bool = False

    def register(self, name: str, function: Function) -> None:
        self.functions[name] = function

    # What holds for all actions.

    @property
    def protected(self) -> tuple[str, ...]:
        return () if self.disable_skip else PROTECTED

    def guarded(self) -> list[Selector]:
        return [Selector.parse(a.field) for a in self.recipe.actions("KEEP")]

    def unremovable(self) -> list[Selector]:
        return [Selector.parse(a.field) for a in self.recipe.header if a.kind in ("REPLACE", "JITTER") and not a.field.startswith(("values:", "fields:"))]

    def call(self, text: str) -> tuple[Function, dict]:
        """The function of a value and its extras."""
        head, _, rest = text.partition(":")
        name, *extras = rest.split()
        known = {**BUILT_IN, **self.functions} if head == "func" else BUILT_IN
        if name not in known:
            raise KeyError(f"no function {name}")
        return known[name], {k: typed(v) for k, v in (p.split("=", 1) for p in extras if "=" in p)}

    def value(self, text: str | None, now: Column, meta: Field, get: Callable[[str], Column], days: Callable[[], Column]) -> Column | None:
        """A value expression; None for one without effect. days: gives the record's offset."""
        if text is None:
            return None
        head, _, rest = text.partition(":")
        if head == "var":
            name = self.variables.get(rest)
            return F.col(name) if name else None
        if head in ("func", "deid_func"):
            function, extras = self.call(text)
            return function(now, meta, get, {"salt": self.salt, "days": days, **extras})
        return V.convert(F.lit(text), meta.vr)

    # Wide form.

    def wide(self, df: DataFrame, fields: list[Field]) -> DataFrame:
        """df with the recipe applied to its columns `fields`; other columns pass through.

        A removed field is NULL, a blanked one ''.
        """
        return _Wide(self, df, fields).run()

    # Tall form.

    def tall(self, df: DataFrame, column: str = "elements") -> DataFrame:
        """df with the recipe applied to its array of elements."""
        return _Tall(self, df, column).run()


def typed(text: str) -> str | bool | None:
    """An extra as it is meant: true, false, none and null are no texts."""
    known = {"true": True, "false": False, "none": None, "null": None}
    return known.get(text.strip(), text.strip())


def reads_others(text: str | None) -> bool:
    return bool(text) and text.startswith(("func:", "deid_func:"))


def _need_salt(extras: dict) -> str:
    if not extras.get("salt"):
        raise ValueError("a salted function needs a salt")
    return extras["salt"]


def _uid(value: Column, extras: dict) -> Column:
    prefix = extras.get("prefix") or V.UID_PREFIX
    return V.random_uid(prefix.rstrip(".")) if extras.get("stable_remapping", True) is False else V.stable_uid(value, "", prefix)


#: The prefix `deid_func:` and the names of its functions. Each gets the value, the field, a getter of other fields, and extras.
BUILT_IN: dict[str, Function] = {
    "id_hash": lambda v, f, get, x: V.id_hash(get("PatientID"), _need_salt(x)),
    "jitter": lambda v, f, get, x: F.coalesce(V.shift(v, x["days"](), f.vr), v),
    "jitter_birthdate_cap_89": lambda v, f, get, x: F.coalesce(V.birth_date_cap(v, x["days"](), get("StudyDate")), v),
    "basic_uuid": lambda v, f, get, x: V.random_uuid(),
    "suffix_uuid": lambda v, f, get, x: V.suffixed_uuid(f.keyword),
    "dicom_uuid": lambda v, f, get, x: V.random_uid(x.get("org_root") or "1.2.826"),
    "pydicom_uuid": lambda v, f, get, x: _uid(v, x),
    "pydicom_uuid_salt": lambda v, f, get, x: V.stable_uid(v, _need_salt(x), x.get("prefix") or V.UID_PREFIX),
}


def field_of(text: str) -> Field:
    """What is known of a field that an action names."""
    tag = tags.by_any(text)
    return Field(tag.keyword, tag.tag, tag.vr, tag.name) if tag else Field(text)


PATIENT = field_of("PatientID")


def group_values(rules: tuple[Rule, ...], get: Callable[[Selector], list[Column]]) -> Column:
    """The distinct values of a values group, read before any action."""
    parts = []
    for rule in rules:
        for value in get(Selector.parse(rule.field)):
            parts.append(V.split_values(value, rule.by, rule.min_length) if rule.kind == "SPLIT" else F.filter(F.array(value), lambda x: x.isNotNull() & (x != "")))
    return F.array_distinct(F.flatten(F.array(*parts))) if parts else F.array().cast("array<string>")


class _Wide:
    def __init__(self, engine: Engine, df: DataFrame, fields: list[Field]):
        self.engine, self.df, self.fields = engine, df, {f.keyword: f for f in fields}
        self.now: dict[str, Column] = {}  # fields rewritten since the last projection
        self.groups: dict[str, str] = {}
        self.has_days = False

    def get(self, name: str) -> Column:
        return self.now.get(name, F.col(name)) if name in self.df.columns or name in self.now else F.lit(None).cast("string")

    def put(self, name: str, value: Column) -> None:
        self.now[name] = value
        if name == "PatientID":
            self.has_days = False

    def flush(self) -> None:
        if self.now:
            self.df = self.df.withColumns(self.now)
            self.now = {}

    def days(self) -> Column:
        """The offset of the patient id as it is by now: a column, so that its digest is made once a record.

        The barrier before each function has written the id down.
        """
        if not self.has_days:
            digest = V.offset_digest(self.get("PatientID"), _need_salt({"salt": self.engine.salt}))
            self.df = self.df.withColumn("__digest", digest).withColumn("__days", V.offset_of(F.col("__digest"))).drop("__digest")
            self.has_days = True
        return F.col("__days")

    def run(self) -> DataFrame:
        engine, recipe = self.engine, self.engine.recipe
        gone = [f for f in self.fields.values() if f.keyword in self.df.columns and ((engine.remove_private and f.is_private) or (engine.strip_sequences and f.vr == "SQ"))]
        if gone:
            self.df = self.df.withColumns({f.keyword: F.lit(None).cast(self.df.schema[f.keyword].dataType) for f in gone})
        guarded = {f.keyword for f in self.fields.values() if f.keyword in engine.protected or any(s.picks(f) for s in engine.guarded())}
        kept = {f.keyword for f in self.fields.values() if any(s.picks(f) for s in engine.unremovable())}
        open_to = [f for f in self.fields.values() if f.keyword not in guarded]
        if recipe.values:
            made = {}
            for name, rules in recipe.values.items():
                self.groups[name] = f"__values_{name}"
                made[self.groups[name]] = group_values(rules, lambda s: [F.col(f.keyword) for f in open_to if s.picks(f)])
            self.df = self.df.withColumns(made)
        for action in recipe.header:
            if (reads_others(action.value) or action.field.startswith("values:")) and self.now:
                self.flush()
            self.act(action, open_to, kept)
        self.flush()
        return self.df.drop(*self.groups.values(), "__days")

    def chosen(self, action: Action, open_to: list[Field]) -> list[tuple[Field, Column]]:
        """Fields that an action selects, each with the condition under which it does."""
        head, _, name = action.field.partition(":")
        if head == "values":
            if name not in self.groups:
                return []
            return [(f, F.coalesce(value_matches(F.col(f.keyword), F.col(self.groups[name])), F.lit(False))) for f in open_to]
        if head == "fields":
            rules = [Selector.parse(r.field) for r in self.engine.recipe.fields.get(name, ())]
            return [(f, F.lit(True)) for f in open_to if any(s.picks(f) for s in rules)]
        selector = Selector.parse(action.field)
        return [(f, F.lit(True)) for f in open_to if selector.picks(f)]

    def act(self, action: Action, open_to: list[Field], kept: set[str]) -> None:
        engine = self.engine
        if action.kind in ("KEEP", "LABEL"):
            return
        if action.kind == "ADD":
            hit = next((f for f in self.fields.values() if Selector.parse(action.field).picks(f)), field_of(action.field))
            self.fields.setdefault(hit.keyword, hit)
            new = engine.value(action.value, self.get(hit.keyword), hit, self.get, self.days)
            if new is not None:
                self.put(hit.keyword, F.coalesce(new.cast("string"), self.get(hit.keyword)))
                if not any(f.keyword == hit.keyword for f in open_to) and hit.keyword not in self.df.columns:
                    open_to.append(hit)
            return
        # All fields of one action read the record as it was before the action.
        before = dict(self.now)
        get = lambda n: before.get(n, F.col(n)) if n in self.df.columns or n in before else F.lit(None).cast("string")
        for f, holds in self.chosen(action, open_to):
            old = get(f.keyword)
            there = old.isNotNull() & holds
            if action.kind == "REPLACE":
                new = engine.value(action.value, old, f, get, self.days)
                if new is not None:
                    self.put(f.keyword, F.when(there, F.coalesce(new.cast("string"), old)).otherwise(old))
            elif action.kind == "JITTER":
                days = engine.value(action.value, old, Field(f.keyword), get, self.days)
                if days is not None:
                    self.put(f.keyword, F.when(there, F.coalesce(V.shift(old, days.try_cast("int"), f.vr), old)).otherwise(old))
            elif action.kind == "REMOVE":
                if f.keyword in kept:
                    continue
                if action.value is not None:
                    condition = engine.value(action.value, old, f, get, self.days)
                    holds = holds & F.coalesce(condition, F.lit(False)) if condition is not None else holds
                self.put(f.keyword, F.when(~holds, old))
            else:  # BLANK, and any unknown kind
                self.put(f.keyword, F.when(there, F.lit("")).otherwise(old))


#: Steps whose bits are kept in one number.
BITS = 60
#: Steps of one expression, so that plans stay of a bounded depth.
LONGEST = 16


@dataclass
class _Step:
    """Actions that are taken together; only actions without a value are ever several."""

    actions: list[Action]

    @property
    def first(self) -> Action:
        return self.actions[0]

    @property
    def group(self) -> str | None:
        """The values group that the step goes by."""
        head, _, name = self.first.field.partition(":")
        return name if head == "values" else None


@dataclass
class _Record:
    """A record between two steps, bound, so that reading it is free."""

    elements: Column
    fixed: Column  # marks of the steps, keywords of the top level
    groups: Column
    values: Column
    there: Column

    def but(self, **parts: Column) -> _Record:
        return replace(self, **parts)

    def get(self, name: str) -> Column:
        """The value of a top-level field."""
        places = F.filter(F.sequence(F.lit(0), F.size(self.there) - 1), lambda at: (F.get(self.fixed["tops"], at) == name) & F.get(self.there, at))
        return F.when(F.size(self.there) > 0, F.get(self.values, F.get(places, F.lit(0))))


class _Tall:
    """A record is three arrays of one length: its elements as they came (with a place for each field that an ADD may
    make), their values, and whether they are there. Steps change the last two only, so identities are never copied;
    a run of steps is one expression in which each binds its arrays for the next. Only Python functions and long
    recipes start another projection."""

    def __init__(self, engine: Engine, df: DataFrame, column: str):
        self.engine, self.df, self.column = engine, df, column
        self.steps: list[_Step] = []
        self.kind = df.schema[column].dataType.elementType
        self.groups = {name: f"g{k}" for k, name in enumerate(engine.recipe.values)}

    def run(self) -> DataFrame:
        engine = self.engine
        elements = F.col(self.column)
        if engine.strip_sequences:
            elements = F.filter(elements, lambda e: (e["vr"] != "SQ") & (e["depth"] == 0))
        if engine.remove_private:
            elements = without_private(elements)
        for action in engine.recipe.header:
            if action.kind in ("KEEP", "LABEL"):
                continue
            plain = lambda a: a.kind in ("REMOVE", "BLANK") and a.value is None and not a.field.startswith("values:")
            if self.steps and plain(action) and plain(self.steps[-1].first) and self.steps[-1].first.kind == action.kind:
                self.steps[-1].actions.append(action)
            else:
                self.steps.append(_Step([action]))
        if not self.steps:
            return self.df.withColumn(self.column, elements)
        made = [field_of(s.first.field) for s in self.steps if s.first.kind == "ADD"]
        self.made = list({f.keyword: f for f in made}.values())
        whole = F.concat(elements, F.array(*[self.blank(f) for f in self.made])) if self.made else elements
        self.df = self.df.withColumn("__groups", F.struct(F.lit(0).alias("none"), *[F.array_distinct(F.flatten(F.array(*[self.rule_values(elements, r) for r in engine.recipe.values[g]]))).alias(n) for g, n in self.groups.items()]))
        self.df = self.df.withColumn(self.column, whole)
        found = F.size(F.col(self.column)) - len(self.made)
        fixed = [F.transform(F.col(self.column), self.marker(n)).alias(f"m{n}") for n in range(-(-len(self.steps) // BITS))]
        fixed.append(F.transform(F.col(self.column), lambda e: F.when(e["depth"] == 0, e["keyword"])).alias("tops"))
        state = F.struct(F.col(self.column)["value"].alias("v"), F.transform(F.col(self.column), lambda e, at: at < found).alias("there"))
        self.df = self.df.withColumns({"__fixed": F.struct(*fixed), "__state": state})
        run: list[int] = []
        for i, step in enumerate(self.steps):
            if self.wide_digits(step):
                self.flush(run)
                self.digits(i, step)
                run = []
            else:
                run.append(i)
                if len(run) == LONGEST:
                    self.flush(run)
                    run = []
        self.flush(run)

        def rebuilt(s: Column) -> Column:
            left = F.transform(F.col(self.column), lambda e, at: F.when(F.get(s["v"], at).eqNullSafe(e["value"]), e).otherwise(e.withField("value", F.get(s["v"], at))))
            return F.filter(left, lambda e, at: F.get(s["there"], at))

        return self.df.withColumn(self.column, let(F.col("__state"), rebuilt)).drop("__groups", "__fixed", "__state")

    def bound(self, body: Callable[[_Record], Column]) -> Column:
        """body(record) with the record's arrays bound."""
        parts = F.struct(F.col(self.column).alias("e"), F.col("__fixed").alias("f"), F.col("__groups").alias("g"), F.col("__state").alias("s"))
        return let(parts, lambda r: body(_Record(r["e"], r["f"], r["g"], r["s"]["v"], r["s"]["there"])))

    def flush(self, run: list[int]) -> None:
        if not run:
            return

        def chain(r: _Record, left: list[int]) -> Column:
            if not left:
                return F.struct(r.values.alias("v"), r.there.alias("there"))
            return self.step(left[0], r, lambda changed: chain(changed, left[1:]))

        todo = list(run)
        self.df = self.df.withColumn("__state", self.bound(lambda r: chain(r, todo)))

    # Which steps select which element.

    def selectors(self, step: _Step) -> list[Selector]:
        out = []
        for a in step.actions:
            head, _, name = a.field.partition(":")
            if head == "fields":
                out += [Selector.parse(r.field) for r in self.engine.recipe.fields.get(name, ())]
            elif head != "values":
                out.append(Selector("exact", a.field) if a.kind == "ADD" else Selector.parse(a.field))
        return out

    def marker(self, number: int) -> Callable[[Column], Column]:
        """An element to the bits of 60 steps."""
        engine = self.engine

        def bits(e: Keyed) -> Column:
            allowed = ~any_of(engine.guarded(), e)
            if engine.protected:
                allowed = allowed & ~(e["grp"].isin(*{f.pair[0] for f in map(tags.by_any, engine.protected) if f}, 2) & e["keyword"].isin(*engine.protected))
            found = [bit(e, allowed, s, at) for at, s in enumerate(self.steps[BITS * number : BITS * (number + 1)])]
            while len(found) > 1:
                found = [x.bitwiseOR(y) for x, y in zip(found[::2], found[1::2], strict=False)] + (found[-1:] if len(found) % 2 else [])
            return found[0]

        def bit(e: Keyed, allowed: Column, step: _Step, at: int) -> Column:
            hit = F.lit(True) if step.group is not None else any_of(self.selectors(step), e)
            if step.first.kind == "ADD":
                hit = hit & (e["depth"] == 0)
            elif step.first.kind == "REMOVE":
                hit = hit & allowed & ~any_of(engine.unremovable(), e)
            else:
                hit = hit & allowed
            return F.when(hit, F.lit(1 << at).cast("long")).otherwise(F.lit(0).cast("long"))

        return lambda element: bits(Keyed(element))

    def selects(self, i: int, r: _Record, at: Column, value: Column) -> Column:
        """Whether step i selects the element at a place."""
        hit = F.get(r.fixed[f"m{i // BITS}"], at).bitwiseAND(F.lit(1 << i % BITS).cast("long")) != 0
        if self.steps[i].group is None:
            return hit
        name = self.groups.get(self.steps[i].group)
        return hit & F.coalesce(value_matches(value, r.groups[name]), F.lit(False)) if name else F.lit(False)

    def rule_values(self, elements: Column, rule: Rule) -> Column:
        selector = Selector.parse(rule.field)
        picked = F.filter(elements, lambda e: selector.column(Keyed(e)) & ~any_of(self.engine.guarded(), Keyed(e)))
        found = F.transform(picked, lambda e: e["value"])
        if rule.kind == "SPLIT":
            return F.flatten(F.transform(found, lambda v: V.split_values(v, rule.by, rule.min_length)))
        return F.filter(found, lambda v: v.isNotNull() & (v != ""))

    # What a value reads of the record.

    def offset(self, r: _Record) -> Column:
        return let(V.offset_digest(r.get("PatientID"), _need_salt({"salt": self.engine.salt})), V.offset_of)

    def reading(self, r: _Record, text: str | None, body: Callable[[Callable[[str], Column], Callable[[], Column]], Column]) -> Column:
        """body(get, days), where what the value `text` reads is found once for the record."""
        if not reads_others(text):
            return body(r.get, lambda: self.offset(r))
        names: list[str] = []
        wants = [False]

        def note(name: str) -> Column:
            if name not in names:
                names.append(name)
            return F.lit(None).cast("string")

        def note_days() -> Column:
            wants[0] = True
            return F.lit(None).cast("int")

        self.engine.value(text, F.lit(None).cast("string"), Field(*[F.lit("")] * 4), note, note_days)
        read = [r.get(n).alias(f"r{k}") for k, n in enumerate(names)] + ([self.offset(r).alias("days")] if wants[0] else [])
        if not read:
            return body(r.get, lambda: self.offset(r))
        return let(F.struct(*read), lambda x: body(lambda n: x[f"r{names.index(n)}"], lambda: x["days"]))

    # The steps.

    def step(self, i: int, r: _Record, then: Callable[[_Record], Column]) -> Column:
        """then(the record after step i)."""
        first, engine = self.steps[i].first, self.engine
        if first.kind == "REMOVE":
            return let(self.left(i, r, first), lambda there: then(r.but(there=there)))
        if first.kind == "ADD":
            made = field_of(first.field)
            new = engine.value(first.value, r.get(made.keyword), made, r.get, lambda: self.offset(r))
            return then(r) if new is None else self.add(i, r, made, new.cast("string"), then)

        def value(get, days) -> Column:
            return F.transform(r.values, lambda v, at: F.when(self.selects(i, r, at, v), self.rewritten(first, v, Field.of(F.get(r.elements, at)), get, days)).otherwise(v))

        return let(self.reading(r, first.value, value), lambda values: then(r.but(values=values)))

    def wide_digits(self, step: _Step) -> bool:
        if step.first.kind != "REPLACE" or not reads_others(step.first.value):
            return False
        function, extras = self.engine.call(step.first.value)
        return function is BUILT_IN["pydicom_uuid_salt"] or (function is BUILT_IN["pydicom_uuid"] and extras.get("stable_remapping", True) is not False)

    def digits(self, i: int, step: _Step) -> None:
        """Digits too wide for the JVM: the selected values of a record cross as one array, as no Python function may stand in a lambda."""
        function, extras = self.engine.call(step.first.value)
        salt = _need_salt({"salt": self.engine.salt}) if function is BUILT_IN["pydicom_uuid_salt"] else ""
        wanted = self.bound(lambda r: F.transform(r.values, lambda v, at: F.when(self.selects(i, r, at, v) & F.get(r.there, at), v)))
        # Both columns are read twice, so that the optimiser leaves each a projection of its own: the call's argument holds no lambda then.
        self.df = self.df.withColumn("__wanted", wanted)
        self.df = self.df.withColumn("__uids", V.stable_uids(F.col("__wanted"), salt, extras.get("prefix") or V.UID_PREFIX))
        values = F.when(F.col("__uids").isNull() | F.col("__wanted").isNull(), F.col("__state.v")).otherwise(F.zip_with(F.col("__state.v"), F.col("__uids"), lambda v, u: F.coalesce(u, v)))
        self.df = self.df.withColumn("__state", F.struct(values.alias("v"), F.col("__state.there").alias("there"))).drop("__uids", "__wanted")

    def left(self, i: int, r: _Record, action: Action) -> Column:
        """What is still there after a removal; whatever lies below a removed sequence goes with it."""

        def kept(get, days) -> Column:
            def stays(there: Column, at: Column) -> Column:
                hit = self.selects(i, r, at, F.get(r.values, at))
                if action.value is not None:
                    hit = hit & F.coalesce(self.engine.value(action.value, F.get(r.values, at), Field.of(F.get(r.elements, at)), get, days), F.lit(False))
                return there & ~hit

            return F.transform(r.there, stays)

        def without_below(left: Column) -> Column:
            gone = F.filter(r.elements, lambda e, at: (e["vr"] == "SQ") & F.get(r.there, at) & ~F.get(left, at))
            inside = lambda above: F.transform(left, lambda ok, at: ok & ~F.exists(above, lambda p: F.get(r.elements, at)["uid"].startswith(p)))
            return let(F.transform(gone, lambda e: F.concat(e["uid"], F.lit("__"))), lambda above: F.when(F.size(above) == 0, left).otherwise(inside(above)))

        return let(self.reading(r, action.value, kept), without_below)

    def blank(self, made: Field) -> Column:
        """The place of a field that an ADD may make."""
        group, number = (int(made.tag[:4], 16), int(made.tag[4:], 16)) if made.tag else (0, 0)
        shown = f"({made.tag[:4]},{made.tag[4:]})" if made.tag else ""
        known = {
            "uid": shown or made.keyword, "name": made.keyword, "keyword": made.keyword, "human": made.human or made.keyword, "tag": shown, "stripped": made.tag,
            "vr": made.vr, "grp": group, "elem": number, "depth": 0, "is_filemeta": group == 2, "is_private": made.is_private,
        }
        return F.struct(*[F.lit(known.get(f.name)).cast(f.dataType).alias(f.name) for f in self.kind.fields])

    def add(self, i: int, r: _Record, made: Field, value: Column, then: Callable[[_Record], Column]) -> Column:
        """Sets a top-level field: the element that is there, or the place kept for it."""
        own = F.size(r.elements) - len(self.made) + [f.keyword for f in self.made].index(made.keyword)

        def put(x: Column) -> Column:
            v, target = x["v"], lambda at: F.when(x["is"], self.selects(i, r, at, F.lit(None).cast("string")) & F.get(r.there, at)).otherwise(at == x["own"])
            values = F.when(v.isNull(), r.values).otherwise(F.transform(r.values, lambda old, at: F.when(target(at), v).otherwise(old)))
            there = F.when(v.isNull() | x["is"], r.there).otherwise(F.transform(r.there, lambda ok, at: ok | (at == x["own"])))
            return let(values, lambda a: let(there, lambda b: then(r.but(values=a, there=b))))

        known = F.exists(F.sequence(F.lit(0), F.size(r.there) - 1), lambda at: F.get(r.there, at) & self.selects(i, r, at, F.lit(None).cast("string")))
        return let(F.struct(value.alias("v"), F.coalesce(known, F.lit(False)).alias("is"), own.alias("own")), put)

    def rewritten(self, action: Action, old: Column, meta: Field, get: Callable[[str], Column], days: Callable[[], Column]) -> Column:
        if action.kind == "REPLACE":
            new = self.engine.value(action.value, old, meta, get, days)
            return old if new is None else F.coalesce(new.cast("string"), old)
        if action.kind == "JITTER":
            by = self.engine.value(action.value, old, Field(""), get, days)
            return old if by is None else F.coalesce(V.shift(old, by.try_cast("int"), meta.vr), old)
        return F.lit("")


def without_private(elements: Column) -> Column:
    """Elements without the private ones and what lies below them."""
    parents = F.transform(F.filter(elements, lambda e: e["is_private"] & (e["vr"] == "SQ")), lambda e: F.concat(e["uid"], F.lit("__")))
    return let(parents, lambda p: F.filter(elements, lambda e: ~e["is_private"] & ~F.exists(p, lambda x: e["uid"].startswith(x))))


def private_elements(elements: Column) -> Column:
    """The private elements of a record, at any depth, in their order."""
    return F.filter(elements, lambda e: e["is_private"])


def has_private(elements: Column) -> Column:
    return F.coalesce(F.exists(elements, lambda e: e["is_private"]), F.lit(False))


def update_field(elements: Column, name: str, value: Column) -> Column:
    """A top-level field set to a value, only where the record has it; an unknown name changes nothing."""
    made = field_of(name)
    return F.transform(elements, lambda e: F.when((e["depth"] == 0) & (e["keyword"] == made.keyword), e.withField("value", value.cast("string"))).otherwise(e))


def as_wide(df: DataFrame, names: list[str], column: str = "elements") -> DataFrame:
    """Top-level fields of a tall frame as columns; other columns pass through."""
    top = df.withColumn("__top", F.filter(F.col(column), lambda e: e["depth"] == 0))
    keys, found = F.col("__top")["keyword"], F.col("__top")["value"]
    # Positions are searched by native loops over one array of keywords; a lambda a name would cost more.
    pick = lambda n: F.when(F.array_contains(keys, n), F.get(found, F.array_position(keys, n).cast("int") - 1)).alias(n)
    return top.select(*[c for c in df.columns if c != column], *[pick(n) for n in names])
