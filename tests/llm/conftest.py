import pytest


@pytest.fixture(autouse=True, scope="session")
def _shipped(spark):
    from rampart.llm import store
    store.ship(spark)


WORDS = ("alpha beta gamma delta eps zeta eta theta iota kappa lam mu nu xi omi pi rho sigma tau ups phi chi psi om "
         "red green blue black white north south east west one two three four five six seven eight nine ten").split()


def prose(n, seed):
    """n words by a fixed rule."""
    out, x = [], seed * 7919 + 17
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[(x >> 8) % len(WORDS)])
    return " ".join(out)


@pytest.fixture(scope="session")
def make(spark):
    """Documents with clashing extra columns and a null in each of them."""
    def build(rows, repartition=3):
        full = [(i, t, None, "s", None, 1, None) for i, t in rows]
        schema = "doc_id long, text string, lang string, source string, id long, hash int, n long"
        return spark.createDataFrame(full, schema).repartition(repartition)
    return build
