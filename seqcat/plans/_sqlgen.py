"""Tiny helpers that spell the same rule tables as SQL ``CASE`` text for the oracle."""


def q(v) -> str:
    return "'" + str(v).replace("'", "''") + "'"


def case_buckets(expr: str, bounds, labels, null_label, neg_label, else_label) -> str:
    arms = [f"WHEN ({expr}) IS NULL THEN {q(null_label)}"]
    if neg_label is not None:
        arms.append(f"WHEN ({expr}) < 0.0 THEN {q(neg_label)}")
    arms += [f"WHEN ({expr}) < CAST({b!r} AS DOUBLE) THEN {q(lab)}" for b, lab in zip(bounds, labels)]
    # NaN compares above every number in both engines -> else arm
    return "CASE " + " ".join(arms) + f" ELSE {q(else_label)} END"


def case_rules(rules, default) -> str:
    arms = []
    for label, conds in rules:
        parts = []
        for kind, col, arg in conds:
            if kind == "in":
                parts.append(f"{col} IN ({', '.join(q(a) for a in arg)})")
            elif kind == "contains":
                parts.append(f"contains({col}, {q(arg)})")
            elif kind == "flag":
                parts.append(f"{col}")
            else:
                raise ValueError(kind)
        arms.append(f"WHEN {' AND '.join(parts)} THEN {q(label)}")
    return "CASE " + " ".join(arms) + f" ELSE {q(default)} END"
