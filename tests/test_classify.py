from lodestar.operators import classify as C
from lodestar.operators import features as FT
from lodestar.operators import split as S
from lodestar.session import shared_dir
from lodestar.sources.tables import FEATURES, POINT_KEY, points_view

COLS = [*FEATURES, "new_feature"]


def data(spark):
    df = FT.derive_and_filter(points_view(spark, "/root/testdata/sf0.01"), 11.0, 0.1)
    return S.hash_split(df.select(*POINT_KEY, *COLS, "label"), POINT_KEY, 0.7)


def test_forest_learns_and_roundtrips(spark):
    train, valid = data(spark)
    model = C.fit_forest(train, COLS, num_trees=4, max_depth=3, seed=42)
    scored = C.score(model, valid, keep=POINT_KEY)
    m = C.metrics(scored).first()
    assert m["n"] == 9387 and m["auc"] > 0.95 and m["accuracy"] > 0.9
    path = shared_dir(spark, "forest-model")
    C.save_model(model, path)
    again = C.score(C.load_model(path), valid, keep=POINT_KEY)
    a = sorted(map(tuple, scored.collect()))
    b = sorted(map(tuple, again.collect()))
    assert a == b


def test_sampled_forest_and_scaler_on_all(spark):
    train, valid = data(spark)
    full = train.unionByName(valid)
    model = C.fit_forest(train, COLS, seed=42, subsampling_rate=0.8, feature_subset="0.8", scaler_data=full)
    m = C.metrics(C.score(model, valid)).first()
    assert m["auc"] > 0.95
