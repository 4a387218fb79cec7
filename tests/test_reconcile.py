from daygrain.plans.reconcile import in_window
from tests.conftest import collected


def test_window_holds_both_its_days_whole(frame):
    orders = frame(
        [("a", "2018-03-04 23:59:59"), ("b", "2018-03-05 00:00:00"), ("c", "2018-03-07 23:59:59"),
         ("d", "2018-03-08 00:00:00"), ("e", None)],
        "order_id string, order_purchase_timestamp timestamp",
    )
    assert collected(in_window(orders, "2018-03-05", "2018-03-07"), "order_id") == [("b",), ("c",)]
