from panelops.llm import caches


def test_a_claim_empties_the_caches_of_others():
    a, b = caches.register("test a", {}), caches.register("test b", {})
    caches.claim("test a")
    a["x"] = 1
    caches.claim("test a")
    assert a == {"x": 1}
    caches.claim("test b")
    assert a == {} and b == {}
