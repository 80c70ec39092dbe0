import random
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import routes


def edge_list(spark, costs):
    return spark.createDataFrame([(i, a, b, c) for (i, a, b), c in costs.items()], "instance string, src string, dst string, cost int")


def random_costs(n, instance="m", seed=4):
    draw, names = random.Random(seed), [chr(97 + i) for i in range(n)]
    return {(instance, a, b): draw.randrange(1, 6) for a in names for b in names if a != b}


def nearest(costs, instance, start):
    names = sorted({a for i, a, _ in costs if i == instance})
    tour, total = [start], 0
    while len(tour) < len(names):
        cost, stop = min((costs[(instance, tour[-1], b)], b) for b in names if b not in tour)
        tour.append(stop)
        total += cost
    return tour, total


def test_route_cost(spark):
    costs = {("m", "a", "b"): 10, ("m", "b", "a"): 3, ("m", "a", "c"): 1, ("m", "c", "b"): 5, ("m", "b", "c"): 5, ("m", "c", "a"): 15}
    candidates = [("m", "r1", ["a", "b", "c"]), ("m", "r2", ["a", "c", "b"]), ("m", "r3", ["a", "x"]), ("m", "r4", ["a"])]
    found = routes.route_cost(spark.createDataFrame(candidates, "instance string, route string, stops array<string>"), edge_list(spark, costs))
    got = {r.route: (r.legs, r.cost, r.closed_cost) for r in found.collect()}
    assert got["r1"] == (2, 15, 30)
    assert got["r2"] == (2, 6, 9)
    assert got["r3"] == (1, None, None)
    assert got["r4"][:2] == (0, 0)
    best = routes.best_route(found.where("route <> 'r4'"), "closed_cost").first()
    assert (best.route, best.closed_cost) == ("r2", 9)


def test_nearest_tours_equal_brute_force(spark):
    costs = random_costs(9) | random_costs(4, "small", 8)
    tours = {(r.instance, r.start): r for r in routes.nearest_tours(edge_list(spark, costs), rounds_per_checkpoint=3).collect()}
    assert len(tours) == 13
    for (instance, start), r in tours.items():
        stops, total = nearest(costs, instance, start)
        assert (r.stops, r.cost, r.complete) == (stops, total, True)


def test_dead_end_and_chosen_starts(spark):
    edges = edge_list(spark, {("m", "a", "b"): 1, ("m", "c", "a"): 1})
    starts = spark.createDataFrame([("m", "a"), ("m", "c")], "instance string, start string")
    got = {r.start: (r.stops, r.complete) for r in routes.nearest_tours(edges, starts).collect()}
    assert got == {"a": (["a", "b"], False), "c": (["c", "a", "b"], True)}


def test_best_of_all_permutations(spark):
    costs = random_costs(4, seed=9)
    names = sorted({a for _, a, _ in costs})
    every = [("m", "-".join(p), list(p)) for p in permutations(names)]
    found = routes.route_cost(spark.createDataFrame(every, "instance string, route string, stops array<string>"), edge_list(spark, costs))
    best = routes.best_route(found, "closed_cost").first()

    def closed(p):
        return sum(costs[("m", a, b)] for a, b in zip(p, (*p[1:], p[0])))

    assert (best.closed_cost, best.route) == min((closed(s), r) for _, r, s in every)
    assert found.agg(F.count("cost")).first()[0] == 24


def brute_tour(costs, instance):
    names = sorted({place for i, a, b in costs if i == instance for place in (a, b)})
    best = None
    for rest in permutations(names[1:]):
        stops = [names[0], *rest]
        legs = [(instance, a, b) for a, b in zip(stops, stops[1:] + stops[:1])]
        if all(leg in costs for leg in legs):
            best = min(best or (float("inf"), []), (sum(costs[leg] for leg in legs), stops))
    return best


def test_exact_tours_equal_brute_force(spark):
    costs = random_costs(9, "nine", 1) | random_costs(4, "four", 2) | random_costs(7, "sparse", 3) | {("pair", "a", "b"): 2, ("pair", "b", "a"): 5}
    draw = random.Random(5)
    costs = {leg: cost for leg, cost in costs.items() if leg[0] != "sparse" or draw.random() < 0.75}
    costs |= {("dead", "a", "b"): 1, ("dead", "b", "c"): 1, ("ties", "a", "b"): 1, ("ties", "b", "a"): 1, ("ties", "a", "c"): 1, ("ties", "c", "a"): 1, ("ties", "b", "c"): 1, ("ties", "c", "b"): 1}
    found = {r.instance: (r.cost, r.stops) for r in routes.exact_tours(edge_list(spark, costs)).collect()}
    want = {i: brute_tour(costs, i) for i in ("nine", "four", "sparse", "pair", "ties", "dead")}
    assert want["sparse"] and found == {i: tour for i, tour in want.items() if tour}


def test_exact_tours_refuse_too_many_places_and_take_none(spark):
    with pytest.raises(ValueError):
        routes.exact_tours(edge_list(spark, random_costs(5)), most_places=4)
    assert routes.exact_tours(edge_list(spark, random_costs(2)).where("false")).collect() == []
