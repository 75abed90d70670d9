"""Training objectives over logged log-probabilities, as column expressions."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tunetable.functions.binding import let


def log_sigmoid(x: Column) -> Column:
    """Stable for large arguments of either sign."""
    return -(F.greatest(-x, F.lit(0.0)) + F.log1p(F.exp(-F.abs(x))))


def sigmoid(x: Column) -> Column:
    return F.exp(log_sigmoid(x))


def softplus(x: Column) -> Column:
    return -log_sigmoid(-x)


def clip(x: Column, low: float | None = None, high: float | None = None) -> Column:
    if low is not None:
        x = F.greatest(x, F.lit(float(low)))
    return x if high is None else F.least(x, F.lit(float(high)))


def smoothed(x: Column, smoothing: float) -> Column:
    return -log_sigmoid(x) * (1 - smoothing) - log_sigmoid(-x) * smoothing


# --- arrays -----------------------------------------------------------------


def array_sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def array_dot(values: Column, mask: Column) -> Column:
    return array_sum(F.zip_with(values, mask, lambda v, m: v * m))


def masked_mean(values: Column, mask: Column) -> Column:
    """Mean over the mask, with at least one in the denominator."""
    return array_dot(values, mask) / F.greatest(array_sum(mask.cast("array<double>")), F.lit(1.0))


def sequence_logp(logps: Column, labels: Column, average: bool = False) -> Column:
    """Sum or mean over the labelled positions."""
    mask = F.transform(labels, lambda x: F.when(x != -100, 1.0).otherwise(0.0))
    total = array_dot(logps, mask)
    return total / array_sum(mask) if average else total


# --- pairs against a reference ----------------------------------------------


def pair_logits(c: Column, r: Column, rc: Column, rr: Column, divergence: str = "reverse_kl", alpha: float = 1.0) -> Column:
    """How much more the policy prefers the chosen side than the reference does."""
    if divergence == "alpha":
        # Fixed value: largest exponent of a 32-bit float, to 4 places.
        power = lambda ratio: F.exp(F.least(ratio * -alpha, F.lit(88.7228)))
        return (power(r - rr) - power(c - rc)) / alpha
    logits = (c - r) - (rc - rr)
    if divergence == "js":
        return logits - (softplus(c - rc) - softplus(r - rr))
    if divergence == "reverse_kl":
        return logits
    raise ValueError(f"unknown divergence {divergence!r}")


def _robust(x, *_, beta, smoothing, **__):
    return (-log_sigmoid(beta * x) * (1 - smoothing) + log_sigmoid(-beta * x) * smoothing) / (1 - 2 * smoothing)


def _exo(x, *_, beta, smoothing, **__):
    s = smoothing or 1e-3
    side = lambda z, share: sigmoid(z) * (log_sigmoid(z) - F.log(F.lit(share)))
    return side(beta * x, 1 - s) + side(-beta * x, s)


def _discopop(x, *_, beta, tau, **__):
    z = beta * x
    share = sigmoid(z / tau)
    return -log_sigmoid(z) * (1 - share) + F.exp(-z) * share


# name -> f(logits, chosen log-ratio, rejected log-ratio, **settings)
PAIR_LOSSES: Mapping[str, Callable[..., Column]] = {
    "sigmoid": lambda x, a, b, *, beta, smoothing, **_: smoothed(beta * x, smoothing),
    "robust": _robust,
    "exo_pair": _exo,
    "hinge": lambda x, a, b, *, beta, **_: F.greatest(1 - beta * x, F.lit(0.0)),
    "ipo": lambda x, a, b, *, beta, **_: F.pow(x - 1 / (2 * beta), F.lit(2.0)),
    "sppo_hard": lambda x, a, b, *, beta, **_: F.pow(a - 0.5 / beta, F.lit(2.0)) + F.pow(b + 0.5 / beta, F.lit(2.0)),
    "nca_pair": lambda x, a, b, *, beta, **_: -log_sigmoid(beta * a) - 0.5 * log_sigmoid(-beta * a) - 0.5 * log_sigmoid(-beta * b),
    "apo_zero": lambda x, a, b, *, beta, **_: 1 - sigmoid(beta * a) + sigmoid(beta * b),
    "apo_down": lambda x, a, b, *, beta, **_: sigmoid(beta * a) + 1 - sigmoid(beta * (a - b)),
    "discopop": _discopop,
    "bco_pair": lambda x, a, b, *, beta, baseline, **_: -log_sigmoid(beta * a - baseline) - log_sigmoid(-(beta * b - baseline)),
    "sft": lambda x, a, b, *, nll, **_: nll,
}


def pair_loss(
    name: str,
    chosen: Column,
    rejected: Column,
    ref_chosen: Column,
    ref_rejected: Column,
    beta: float = 0.1,
    smoothing: float = 0.0,
    tau: float = 0.05,
    divergence: str = "reverse_kl",
    alpha: float = 1.0,
    baseline: Column | None = None,
    nll: Column | None = None,
) -> Column:
    """One row-local loss of the pair family. ``baseline`` is for ``bco_pair``, ``nll`` for ``sft``."""
    if name not in PAIR_LOSSES:
        raise ValueError(f"unknown pair loss {name!r}; one of {sorted(PAIR_LOSSES)}")
    logits = pair_logits(chosen, rejected, ref_chosen, ref_rejected, divergence, alpha)
    return PAIR_LOSSES[name](
        logits, chosen - ref_chosen, rejected - ref_rejected, beta=beta, smoothing=smoothing, tau=tau, baseline=baseline, nll=nll
    )


def implicit_reward(logp: Column, ref: Column, beta: float = 0.1) -> Column:
    return beta * (logp - ref)


def length_desensitised(logps: Column, shared: Column, alpha: float) -> Column:
    """Full weight up to the shorter side's length, ``alpha`` after it."""
    return let(shared, lambda n: array_sum(F.transform(logps, lambda x, i: F.when(i < n, x).otherwise(x * alpha))))


def pair_confidence(chosen_adjusted: Column, rejected_adjusted: Column) -> Column:
    """Weight of a pair from the mean adjusted log-probs of its sides, at most 1."""
    return F.least(F.exp(chosen_adjusted + rejected_adjusted), F.lit(1.0))


# --- unpaired ---------------------------------------------------------------


def unpaired_loss(
    name: str, label: Column, ratio: Column, kl: Column, beta: float = 0.1, good: float = 1.0, bad: float = 1.0
) -> Column:
    """``kto`` or ``apo_zero_unpaired``; ``kl`` is the batch estimate, clamped at 0."""
    if name == "kto":
        up, down = 1 - sigmoid(beta * (ratio - kl)), 1 - sigmoid(beta * (kl - ratio))
    elif name == "apo_zero_unpaired":
        up, down = 1 - sigmoid(beta * ratio), sigmoid(beta * ratio)
    else:
        raise ValueError(f"unknown unpaired loss {name!r}")
    return F.when(label, good * up).otherwise(bad * down)


def density_ratio_weight(p: Column, low: float, high: float) -> Column:
    return clip(p / (1 - p + 1e-8), low, high)


def classifier_loss(label: Column, reward: Column, baseline: Column, weight: Column | None = None) -> Column:
    """Binary-classifier objective around a running baseline."""
    down = -log_sigmoid(-(reward - baseline))
    return F.when(label, -log_sigmoid(reward - baseline)).otherwise(down if weight is None else weight * down)


# --- without a reference ----------------------------------------------------


def alpha_reward(logp: Column, alpha: float) -> Column:
    return (1 - F.exp(-alpha * logp)) / alpha if alpha else logp


def free_pair_loss(
    name: str, chosen: Column, rejected: Column, beta: float = 0.1, gamma: float = 0.5, smoothing: float = 0.0, alpha: float = 0.0
) -> Column:
    x = alpha_reward(chosen, alpha) - alpha_reward(rejected, alpha)
    losses = {
        "simpo": lambda: smoothed(beta * (x - gamma / beta), smoothing),
        "sigmoid": lambda: smoothed(beta * x, smoothing),
        "hinge": lambda: F.greatest(1 - beta * x, F.lit(0.0)),
        "ipo": lambda: F.pow(x - 1 / (2 * beta), F.lit(2.0)),
    }
    if name not in losses:
        raise ValueError(f"unknown loss {name!r}; one of {sorted(losses)}")
    return losses[name]()


def log_odds(chosen: Column, rejected: Column) -> Column:
    return (chosen - rejected) - (F.log1p(-F.exp(chosen)) - F.log1p(-F.exp(rejected)))


def odds_ratio_term(chosen: Column, rejected: Column, beta: float = 0.1) -> Column:
    """Subtracted from the likelihood loss."""
    return beta * log_sigmoid(log_odds(chosen, rejected))


def reward_model_loss(chosen: Column, rejected: Column, margin: Column | None = None, centre: float | None = None) -> Column:
    """Row loss; the centring term uses the row's own scores."""
    gap = chosen - rejected if margin is None else chosen - rejected - margin
    loss = -log_sigmoid(gap)
    return loss if centre is None else loss + centre * F.pow(chosen + rejected, F.lit(2.0))


def weighted_token_loss(logps: Column, mask: Column) -> Column:
    """Sum of ``-p * log p`` over labelled tokens."""
    return array_dot(F.transform(logps, lambda x: -F.exp(x) * x), mask)


# --- two data sources -------------------------------------------------------


def exploratory_losses(
    model_is_chosen: Column, model_m: Column, model_r: Column, ref_m: Column, ref_r: Column, beta: float, alpha: float, kind: str = "sigmoid"
) -> tuple[Column, Column]:
    """Pair loss and exploration bonus from log-probs of both models on both sources.

    ``model_m``: the model on its own data; ``model_r``: on the reference's data.
    """
    m_ratio, r_ratio = model_m - ref_m, model_r - ref_r
    logits = F.when(model_is_chosen, m_ratio - r_ratio).otherwise(r_ratio - m_ratio)
    pair = -log_sigmoid(beta * logits) if kind == "sigmoid" else F.pow(logits - 1 / (2 * beta), F.lit(2.0))
    return pair, alpha * model_r


def game_loss(probability: Column, policy: Column, ref: Column, beta: float) -> Column:
    """Game-value loss from token log-prob arrays and the judge's win probability."""
    score = (probability - 0.5) * array_sum(policy)
    kl = array_sum(F.zip_with(policy, ref, lambda p, r: (p - r) * p))
    return beta * kl - score


# --- token level ------------------------------------------------------------


def k3(policy: Column, ref: Column) -> Column:
    return F.exp(ref - policy) - (ref - policy) - 1


def k1(policy: Column, ref: Column) -> Column:
    return policy - ref


def importance_log_weights(policy: Column, old: Column, mask: Column, level: str = "token") -> Column:
    """Log-ratios per token; the sequence levels repeat the masked mean at every position."""
    log_ratio = F.zip_with(policy, old, lambda p, o: p - o)
    if level == "token":
        return log_ratio
    if level in ("sequence", "sequence_token"):
        return F.array_repeat(masked_mean(log_ratio, mask), F.size(log_ratio))
    raise ValueError(f"unknown level {level!r}")


def sampler_correction(old: Column, sampled: Column, mask: Column, mode: str, cap: float) -> Column:
    """Importance ratio of the sampler, per token or one per sequence."""
    diff = F.zip_with(F.zip_with(old, sampled, lambda o, s: o - s), mask, lambda d, m: d * m)
    level, rule = mode.split("_")
    if rule not in ("truncate", "mask") or level not in ("token", "sequence"):
        raise ValueError(f"unknown mode {mode!r}")
    bound = lambda x: clip(x, high=cap) if rule == "truncate" else F.when(x > cap, 0.0).otherwise(x)
    if level == "sequence":
        return F.array(bound(F.exp(array_sum(diff))))
    return F.transform(diff, lambda d: bound(F.exp(d)))


def token_losses(
    form: str,
    log_weights: Column,
    policy: Column,
    advantage: Column,
    low: float = 0.2,
    high: float = 0.2,
    delta: float | None = None,
    temperature: tuple[float, float] = (1.0, 1.05),
) -> Column:
    """Clipped objective per token, for all loss forms."""
    if form == "cispo":
        return F.zip_with(log_weights, policy, lambda w, p: -clip(F.exp(w), high=high) * advantage * p)
    if form == "sapo":
        gate = lambda x, t: sigmoid((x - 1) * t) * 4 / t
        pos, neg = temperature
        return F.transform(
            log_weights, lambda w: -F.when(advantage > 0, gate(F.exp(w), pos)).otherwise(gate(F.exp(w), neg)) * advantage
        )
    if form not in ("grpo", "bnpo", "dr_grpo", "dapo"):
        raise ValueError(f"unknown form {form!r}")
    return F.transform(
        log_weights,
        lambda w: -F.least(clip(F.exp(w), high=delta) * advantage, clip(F.exp(w), 1 - low, 1 + high) * advantage),
    )


def reduce_token_losses(form: str, losses: Column, mask: Column, max_length: int | None = None, n_tokens: Column | None = None) -> Column:
    """Aggregate expression for one loss form over all rows."""
    total = F.sum(array_dot(losses, mask))
    tokens = F.sum(array_sum(mask.cast("array<double>")))
    if form in ("grpo", "sapo"):
        return F.avg(masked_mean(losses, mask))
    if form == "bnpo":
        return total / F.greatest(tokens, F.lit(1.0))
    if form == "dr_grpo":
        return total / (F.count("*") * max_length)
    if form in ("cispo", "dapo"):
        return total / (tokens if n_tokens is None else n_tokens)
    raise ValueError(f"unknown form {form!r}")


def clip_flags(log_weights: Column, advantage: Column, low: float = 0.2, high: float = 0.2) -> tuple[Column, Column]:
    """0/1 per token: clipped at the low end, clipped at the high end."""
    one = lambda cond: F.when(cond, 1.0).otherwise(0.0)
    return (
        F.transform(log_weights, lambda w: one((F.exp(w) < 1 - low) & (advantage < 0))),
        F.transform(log_weights, lambda w: one((F.exp(w) > 1 + high) & (advantage > 0))),
    )


_BLOCK = 128  # appending to an array copies it, so long rows are scanned in blocks


def backward_scan(deltas: Column, decay: float) -> Column:
    """``y[t] = x[t] + decay * y[t+1]`` inside one row."""
    nothing = F.array().cast("array<double>")
    tail = lambda done: F.get(done, F.size(done) - 1)

    def scan_block(done: Column, block: Column) -> Column:
        carry = F.coalesce(tail(done), F.lit(0.0))
        step = lambda o, x: F.array_append(o, x + decay * F.coalesce(tail(o), carry))
        return F.concat(done, F.aggregate(block, nothing, step))

    def scan(rev: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(rev), F.lit(_BLOCK))
        blocks = F.transform(starts, lambda i: F.slice(rev, i, _BLOCK))
        return F.when(F.size(rev) > 0, F.aggregate(blocks, nothing, scan_block)).otherwise(nothing)

    return F.reverse(let(F.reverse(deltas), scan))


def running_sum(values: Column) -> Column:
    """Sums up to and including each entry of a list of doubles."""
    return F.reverse(backward_scan(F.reverse(values), 1.0))



def generalised_advantage(rewards: Column, values: Column, gamma: float, lam: float) -> tuple[Column, Column]:
    """Token-level advantages and returns."""
    deltas = let(
        values,
        lambda v: F.transform(rewards, lambda r, t: r + gamma * F.coalesce(F.get(v, t + 1), F.lit(0.0)) - F.get(v, t)),
    )
    advantages = backward_scan(deltas, gamma * lam)
    return advantages, F.zip_with(advantages, values, lambda a, v: a + v)


def shaped_rewards(policy: Column, ref: Column, score: Column, end: Column, coef: float, estimator: str = "k1") -> Column:
    """KL penalty per token, with the score added at the 0-based end position."""
    kl = {"k1": k1, "k3": k3}[estimator]
    penalty = F.zip_with(policy, ref, lambda p, r: -coef * kl(p, r))
    return F.transform(penalty, lambda x, i: F.when(i == end, x + score).otherwise(x))


def discounted_suffix(student: Column, teacher: Column, gamma: float, normalise: bool = False, divide: bool = False) -> Column:
    """Suffix sums of ``gamma**t * (teacher - student)``.

    The discount counts from the start of the row; ``divide`` gives the
    textbook form that counts from ``t``. ``normalise`` divides by the same sum of ones.
    """
    rewards = F.zip_with(teacher, student, lambda t, s: t - s)
    if gamma <= 0:
        return rewards
    power = lambda i: F.pow(F.lit(float(gamma)), i.cast("double"))
    sums = backward_scan(F.transform(rewards, lambda r, i: r * power(i)), 1.0)
    if normalise:
        ones = backward_scan(F.transform(rewards, lambda r, i: power(i)), 1.0)
        return F.zip_with(sums, ones, lambda a, b: a / b)
    return F.transform(sums, lambda s, i: s / power(i)) if divide else sums


def clipped_value_loss(values: Column, old_values: Column, returns: Column, bound: float) -> Column:
    """Larger squared error of the value and its clipped version, per token."""
    clipped = F.zip_with(values, old_values, lambda v, o: F.least(F.greatest(v, o - bound), o + bound))
    worst = lambda pair, ret: F.greatest(F.pow(pair.v - ret, F.lit(2.0)), F.pow(pair.c - ret, F.lit(2.0)))
    pairs = F.zip_with(values, clipped, lambda v, c: F.struct(v.alias("v"), c.alias("c")))
    return F.zip_with(pairs, returns, worst)


def clipped_policy_loss(new: Column, old: Column, advantages: Column, bound: float) -> Column:
    ratio = F.zip_with(new, old, lambda n, o: F.exp(n - o))
    return F.zip_with(ratio, advantages, lambda r, a: F.greatest(-a * r, -a * clip(r, 1 - bound, 1 + bound)))


def perception_kl(policy: Column, masked_image: Column) -> Column:
    """k3 estimate per token, clamped to [0, 0.2]."""
    return F.zip_with(policy, masked_image, lambda p, m: clip(k3(p, m), 0.0, 0.2))


def log_softmax(scores: Column) -> Column:
    def normalise(v: Column) -> Column:
        shifted = let(F.array_max(v), lambda top: F.transform(v, lambda x: x - top))
        return let(shifted, lambda z: let(F.log(array_sum(F.transform(z, F.exp))), lambda n: F.transform(z, lambda x: x - n)))

    return let(scores, normalise)


def entropy(scores: Column) -> Column:
    """Entropy of the softmax of a score list."""
    return F.aggregate(log_softmax(scores), F.lit(0.0), lambda a, x: a - F.exp(x) * x)


def divergence_term(student: Column, teacher: Column, beta: float) -> Column:
    """One token's share of the generalised Jensen-Shannon divergence, from probabilities."""
    kl = lambda p, q: F.when(p > 0, p * (F.log(p) - F.log(q))).otherwise(0.0)
    if beta == 0:
        return kl(teacher, student)
    if beta == 1:
        return kl(student, teacher)
    mix = (1 - beta) * student + beta * teacher
    return beta * kl(teacher, mix) + (1 - beta) * kl(student, mix)
