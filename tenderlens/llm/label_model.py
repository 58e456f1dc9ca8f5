"""A generative model of noisy voters, and a linear classifier on its posterior labels.

Each voter says toxic (1), clean (-1) or nothing (0), and silence is no evidence.  Expectation
maximisation estimates how often each says what for toxic and for clean texts.  Given labels, which may
be wrong at a stated rate, anchor the two classes.  Voters that still agree within a class tell the
same thing twice, so their correlations there are estimated too, and a voter counts the less the
more it shares with others.
"""

from dataclasses import dataclass

import numpy as np

VOTES = (-1, 0, 1)


@dataclass
class LabelModel:
    """``says[y, j, v]``: probability that voter j gives vote ``VOTES[v]`` if the class is y."""

    prior: float
    says: np.ndarray
    correlation: np.ndarray
    share: np.ndarray
    trust: float

    def accuracy(self) -> np.ndarray:
        """Probability that a voter is right when it votes."""
        right = (1 - self.prior) * self.says[0, :, 0] + self.prior * self.says[1, :, 2]
        wrong = (1 - self.prior) * self.says[0, :, 2] + self.prior * self.says[1, :, 0]
        return right / (right + wrong)

    def posterior(self, votes: np.ndarray, given: np.ndarray | float = 0.0) -> np.ndarray:
        """Probability that each row is toxic; ``given`` is its label as 1 or -1, or 0 if it has none."""
        ratio = np.log(self.says[1]) - np.log(self.says[0])
        ratio[:, 1] = 0.0
        evidence = np.take_along_axis(ratio.T, votes.astype(np.int64) + 1, axis=0)
        odds = np.log(self.prior / (1 - self.prior)) + evidence @ self.share
        odds = odds + given * np.log(self.trust / (1 - self.trust))
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def _correlation(votes: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Correlation of the votes within the classes, both classes pooled."""
    total = np.zeros((votes.shape[1],) * 2)
    for part in (weight * toxic, weight * (1 - toxic)):
        if part.sum() > 0:
            centred = votes - (part @ votes) / part.sum()
            total += (centred * part[:, None]).T @ centred
    scale = np.sqrt(np.maximum(np.diag(total), 1e-12))
    return total / scale[:, None] / scale


def fit_label_model(
    votes: np.ndarray, given: np.ndarray, weight: np.ndarray, trust: float = 0.95, rounds: int = 25
) -> LabelModel:
    """The model of ``votes`` (rows by voters) with the given labels (1, -1 or 0 for none).

    ``trust`` is the share of given labels that are right, ``weight`` counts a row several times.  One vote of
    each kind is added per class, so nothing is impossible.
    """
    toxic = np.where(given > 0, trust, np.where(given < 0, 1 - trust, 0.5))
    model = None
    for _ in range(rounds):
        says = np.empty((2, votes.shape[1], 3))
        for y, part in enumerate((weight * (1 - toxic), weight * toxic)):
            for v, vote in enumerate(VOTES):
                says[y, :, v] = part @ (votes == vote) + 1
            says[y] /= says[y].sum(axis=1, keepdims=True)
        correlation = _correlation(votes, toxic, weight)
        shared = np.maximum(correlation, 0).sum(axis=0)  # with itself 1
        prior = float(np.clip((weight @ toxic) / weight.sum(), 1e-4, 1 - 1e-4))
        model = LabelModel(prior, says, correlation, 1 / np.maximum(shared, 1), trust)
        found = model.posterior(votes, given)
        done = np.abs(found - toxic).max() < 1e-4
        toxic = found
        if done:
            break
    return model


def fit_linear(x: np.ndarray, target: np.ndarray, weight: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Weights of a logistic regression on soft targets by Newton's method; the last is the intercept."""
    x = np.column_stack([x, np.ones(len(x))])
    penalty = np.diag([ridge] * (x.shape[1] - 1) + [1e-6])
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (weight * (p - target)) + penalty @ beta
        curve = np.maximum(weight * p * (1 - p), 1e-9)
        step = np.linalg.solve((x * curve[:, None]).T @ x + penalty, gradient)
        step *= min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        beta -= step
        if np.abs(step).max() < 1e-7:
            break
    return beta
