"""Estimation of additive smoothing, many series at once: starting states and parameters together.

With the three parameters fixed, every one-step error is affine in the starting states
(level, trend, and the seasons, which sum to zero because a shift between them and the
level changes no fit). So the recursion carries, instead of numbers, the coefficients of
the starting states; they are the equations of a least-squares problem, and its solution
gives the best starting states and the least squared error of these parameters. What is left is a search over three parameters in [0, 1].

That search is Gauss-Newton with damping: a second recursion carries the derivatives of the
states by the parameters as well. A step that does not lower the error is made smaller. It
starts at the best parameters of a grid, so the error is never above that of the grid,
and at a few fixed places; it finds the lowest of the valleys these lie in. All series of a batch take their steps side by side; those that have
arrived are left out.

The functions take rows of values of different lengths, padded at the end.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import product

import numpy as np

# Where the search starts besides the best set of the grid.
OTHER_STARTS = ((0.1, 0.01, 0.1), (0.5, 0.1, 0.3))
ROUNDS = 40
TOLERANCE = 1e-9
# Series that run side by side, so that the coefficients stay small, and days whose equations are folded at once.
BLOCK = 128
FOLD = 64


def mean_states(values: np.ndarray, period: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Level, trend and seasons from the means of the first two periods."""
    level = values[:, :period].mean(axis=1)
    trend = (values[:, period:2 * period].mean(axis=1) - level) / period
    return level, trend, values[:, :period] - level[:, None]


def grid_errors(values: np.ndarray, days: np.ndarray, period: int, parameters: np.ndarray) -> np.ndarray:
    """Squared errors (series x sets) from the mean states; `parameters` is (series or 1, sets, 3)."""
    level, trend, season = mean_states(values, period)
    alpha, beta, gamma = np.moveaxis(np.broadcast_to(parameters, (len(values), *parameters.shape[1:])), 2, 0)
    seasons = [np.repeat(season[:, [i]], alpha.shape[1], axis=1) for i in range(period)]
    level, trend = (np.repeat(x[:, None], alpha.shape[1], axis=1) for x in (level, trend))
    errors = np.zeros(alpha.shape)
    for day in range(values.shape[1]):
        y, past = values[:, [day]], seasons[day % period]
        expected = level + trend
        error = y - expected - past
        errors += np.where(day < days[:, None], error * error, 0.0)
        new = alpha * (y - past) + (1 - alpha) * expected
        trend = beta * (new - level) + (1 - beta) * trend
        seasons[day % period] = gamma * (y - expected) + (1 - gamma) * past
        level = new
    return errors


def best_of_grid(values: np.ndarray, days: np.ndarray, period: int, coarse: Sequence[Sequence[float]],
                 fine: Sequence[Sequence[float]] | None) -> tuple[np.ndarray, np.ndarray]:
    """The parameters (series x 3) with the least error on the grid, and that error; of equal sets the lowest."""
    points = np.array(sorted(set(product(*coarse))))[None]

    def least(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        errors = grid_errors(values, days, period, points)
        at = np.nanargmin(np.where(np.isnan(errors), np.inf, errors), axis=1)
        rows = np.arange(len(values))
        return np.broadcast_to(points, (len(values), *points.shape[1:]))[rows, at], errors[rows, at]

    chosen, errors = least(points)
    if fine is not None:
        steps = np.array(sorted(set(product(*fine))))
        chosen, errors = least(np.clip(chosen[:, None] + steps[None], 0.0, 1.0))
    return chosen, errors


def _start_coefficients(rows: int, period: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Level, trend and seasons as coefficients of (level, trend, seasons but the last, 1)."""
    unknown = period + 1
    level, trend = np.zeros((rows, unknown + 1)), np.zeros((rows, unknown + 1))
    level[:, 0] = 1.0
    trend[:, 1] = 1.0
    seasons = []
    for i in range(period):
        season = np.zeros((rows, unknown + 1))
        if i < period - 1:
            season[:, 2 + i] = 1.0
        else:
            season[:, 2:unknown] = -1.0
        seasons.append(season)
    return level, trend, seasons


def best_states(values: np.ndarray, days: np.ndarray, period: int, parameters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The starting states (rows x period + 1) with the least squared error for each row's parameters, and that error.

    The equations of some days at a time are folded into one triangular system by QR, which
    keeps the digits that sums of products would lose where parameters let old states grow.
    """
    alpha, beta, gamma = parameters.T[:, :, None]
    level, trend, seasons = _start_coefficients(len(values), period)
    unknown = period + 1
    held = unknown + 1
    rows = np.zeros((len(values), held + FOLD, held))
    for day in range(values.shape[1]):
        past = seasons[day % period]
        expected = level + trend
        error = -(expected + past)
        error[:, -1] += values[:, day]
        error[day >= days] = 0.0
        rows[:, held + day % FOLD] = error
        if day % FOLD == FOLD - 1 or day == values.shape[1] - 1:
            rows[:, :held] = np.linalg.qr(rows, mode="r")
            rows[:, held:] = 0.0
        new = alpha * -past + (1 - alpha) * expected
        new[:, -1] += parameters[:, 0] * values[:, day]
        trend = beta * (new - level) + (1 - beta) * trend
        season = gamma * -expected + (1 - gamma) * past
        season[:, -1] += parameters[:, 2] * values[:, day]
        seasons[day % period] = season
        level = new
    triangle, right = rows[:, :unknown, :unknown], rows[:, :unknown, unknown]
    # Coefficients that have no say, like those of a level forgotten at once, get the smallest states.
    states = -(np.linalg.pinv(triangle, rcond=1e-13) @ right[:, :, None])[:, :, 0]
    left = (triangle @ states[:, :, None])[:, :, 0] + right
    return states, (left ** 2).sum(axis=1) + rows[:, unknown, unknown] ** 2


def derivatives(values: np.ndarray, days: np.ndarray, period: int, parameters: np.ndarray,
                states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of products of the errors' derivatives by parameters and starting states, and of them with the errors."""
    alpha, beta, gamma = parameters.T
    a, b, g = parameters.T[:, :, None]
    rows, unknown = len(values), period + 1
    d_level, d_trend, d_seasons = (
        _widened(x) for x in _start_coefficients(rows, period))
    level, trend = states[:, 0], states[:, 1]
    seasons = [*states[:, 2:].T, -states[:, 2:].sum(axis=1)]
    products, slopes = np.zeros((rows, unknown + 3, unknown + 3)), np.zeros((rows, unknown + 3))
    for day in range(values.shape[1]):
        y, past, d_past = values[:, day], seasons[day % period], d_seasons[day % period]
        expected, d_expected = level + trend, d_level + d_trend
        error = np.where(day < days, y - expected - past, 0.0)
        d_error = -(d_expected + d_past)
        d_error[day >= days] = 0.0
        products += d_error[:, :, None] * d_error[:, None, :]
        slopes += d_error * error[:, None]
        new, d_new = alpha * (y - past) + (1 - alpha) * expected, (1 - a) * d_expected - a * d_past
        d_new[:, 0] += y - past - expected
        d_next = b * (d_new - d_level) + (1 - b) * d_trend
        d_next[:, 1] += new - level - trend
        d_season = (1 - g) * d_past - g * d_expected
        d_season[:, 2] += y - expected - past
        trend = beta * (new - level) + (1 - beta) * trend
        seasons[day % period], d_seasons[day % period] = gamma * (y - expected) + (1 - gamma) * past, d_season
        level, d_level, d_trend = new, d_new, d_next
    return products, slopes


def _widened(coefficients):
    """Three columns for the parameters before those of the starting states, none for the constant."""
    if isinstance(coefficients, list):
        return [_widened(c) for c in coefficients]
    return np.concatenate([np.zeros((len(coefficients), 3)), coefficients[:, :-1]], axis=1)


def refined(values: np.ndarray, days: np.ndarray, period: int, parameters: np.ndarray,
            rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Parameters, starting states and squared error after damped Gauss-Newton steps from `parameters`."""
    parameters = parameters.copy()
    states, errors = best_states(values, days, period, parameters)
    damping = np.full(len(values), 1e-3)
    products, slopes = derivatives(values, days, period, parameters, states)
    going = np.arange(len(values))
    for _ in range(rounds):
        if not len(going):
            break
        system, right = products[going].copy(), slopes[going].copy()
        # A parameter at its bound that would leave it stays.
        stuck = ((parameters[going] <= 0) & (right[:, :3] > 0)) | ((parameters[going] >= 1) & (right[:, :3] < 0))
        rows, columns = np.nonzero(stuck)
        system[rows, columns, :] = 0.0
        system[rows, :, columns] = 0.0
        right[rows, columns] = 0.0
        diagonal = np.einsum("rii->ri", system)
        diagonal += damping[going, None] * diagonal + 1e-12 * np.maximum(diagonal.max(axis=1, keepdims=True), 1e-300)
        step = -np.linalg.solve(system, right[:, :, None])[:, :3, 0]
        tried = np.clip(parameters[going] + step, 0.0, 1.0)
        moved = np.abs(tried - parameters[going]).max(axis=1)
        new_states, new_errors = best_states(values[going], days[going], period, tried)
        better = new_errors < errors[going]
        gain = (errors[going] - new_errors) / np.maximum(errors[going], 1e-300)
        damping[going] = np.clip(np.where(better, damping[going] / 5, damping[going] * 6), 1e-12, 1e12)
        won = going[better]
        parameters[won], states[won], errors[won] = tried[better], new_states[better], new_errors[better]
        arrived = (better & (gain < TOLERANCE)) | (moved < 1e-9) | (damping[going] >= 1e9)
        stay = won[~arrived[better]]
        if len(stay):
            products[stay], slopes[stay] = derivatives(values[stay], days[stay], period, parameters[stay], states[stay])
        going = going[~arrived]
    return parameters, states, errors


def blocks(series: Sequence[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(places, padded values, days) of at most BLOCK series; neighbours in length share a block, so little is padded."""
    order = np.argsort([len(values) for values in series], kind="stable")
    for at in range(0, len(order), BLOCK):
        block = order[at:at + BLOCK]
        days = np.array([len(series[i]) for i in block])
        values = np.zeros((len(block), days.max()))
        for row, i in enumerate(block):
            values[row, :days[row]] = series[i]
        yield block, values, days


def _all_states(states: np.ndarray) -> np.ndarray:
    """With the last season, which is minus the sum of the others."""
    return np.concatenate([states, -states[:, 2:].sum(axis=1, keepdims=True)], axis=1)


def estimated(series: Sequence[np.ndarray], period: int, coarse: Sequence[Sequence[float]],
              fine: Sequence[Sequence[float]] | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Parameters (series x 3), starting states (series x period + 2: level, trend, seasons) and the grid's error.

    Every series needs at least two periods.
    """
    found, starts, from_grid = np.empty((len(series), 3)), np.empty((len(series), period + 2)), np.empty(len(series))
    for block, values, days in blocks(series):
        scale = np.abs(values).sum(axis=1) / days
        scale = np.where((scale > 0) & np.isfinite(scale), scale, 1.0)
        values = values / scale[:, None]
        grid, grid_error = best_of_grid(values, days, period, coarse, fine)
        tries = [grid, *(np.tile(start, (len(block), 1)) for start in OTHER_STARTS)]
        parameters, states, errors = refined(
            np.tile(values, (len(tries), 1)), np.tile(days, len(tries)), period, np.concatenate(tries))
        # The first of equal errors, that is, the one found from the grid.
        best = np.argmin(errors.reshape(len(tries), -1), axis=0) * len(block) + np.arange(len(block))
        found[block] = parameters[best]
        starts[block] = _all_states(states[best]) * scale[:, None]
        from_grid[block] = grid_error * scale ** 2
    return found, starts, from_grid


def states_for(series: Sequence[np.ndarray], period: int, parameters: Sequence[float]) -> np.ndarray:
    """The best starting states (series x period + 2) of given parameters."""
    starts = np.empty((len(series), period + 2))
    for block, values, days in blocks(series):
        starts[block] = _all_states(best_states(values, days, period, np.tile(parameters, (len(block), 1)))[0])
    return starts
