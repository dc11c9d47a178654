"""A session of two products with faults, made by rules, and raw rows for the batch models."""

from datetime import UTC, datetime, timedelta

CLOCK = datetime(2026, 5, 4, 9, 30, tzinfo=UTC)
ETH, SOL = "ETH-USD", "SOL-USD"
PRODUCTS = [ETH, SOL]


def at(seconds: float) -> str:
    return (CLOCK + timedelta(seconds=seconds)).strftime("%Y-%m-%dT%H:%M:%S.%fZ")


class Recorder:
    """Appends messages, one second and one sequence number after another."""

    def __init__(self) -> None:
        self.messages: list[dict] = []

    def add(self, kind: str, product: str, timed: bool = True, **fields) -> None:
        n = len(self.messages)
        self.messages.append({"type": kind, "product_id": product, "sequence": 9000 + n, **fields} | ({"time": at(n)} if timed else {}))

    def trades(self, product: str, *ids: int, price: str = "20", kind: str = "match") -> None:
        for i in ids:
            self.add(kind, product, trade_id=i, price=price, size="0.4", side="sell" if i % 3 else "buy")

    def book(self, product: str, middle: int, levels: int = 4) -> None:
        """A snapshot of whole prices around ``middle``, one unit more at each step away."""
        ladder = lambda step: [[str(middle + step * i), str(i)] for i in range(1, levels + 1)]
        self.add("snapshot", product, timed=False, bids=ladder(-1), asks=ladder(1))

    def delta(self, product: str, *changes: tuple[str, str, str]) -> None:
        self.add("l2update", product, changes=[list(c) for c in changes])

    def beat(self, product: str, last: int) -> None:
        self.add("heartbeat", product, last_trade_id=last)

    def cut(self) -> None:
        self.messages.append({"type": "__disconnect__"})


def session() -> list[dict]:
    r = Recorder()
    r.messages.append({"type": "subscriptions"})
    # first connection: deltas come before a book, a heartbeat before any trade
    r.delta(SOL, ("buy", "7", "7"))
    r.beat(SOL, 300)
    r.book(ETH, 20)
    r.trades(ETH, 610, kind="last_match")
    r.trades(SOL, 301, 302)
    r.trades(ETH, 611, 612)
    r.book(SOL, 50, 2)
    # ETH loses 613 and 614, gets 612 again, and a heartbeat shows that 616 to 618 never came
    r.trades(ETH, 615, 612)
    r.beat(ETH, 618)
    r.beat(ETH, 618)
    # a better bid, gone again; then a bid that crosses, and is taken back
    r.delta(ETH, ("buy", "19.5", "3"), ("sell", "24", "0"))
    r.delta(ETH, ("buy", "19.5", "0.0"))
    r.delta(SOL, ("buy", "51", "1"))
    r.delta(SOL, ("buy", "51.0", "0"))
    r.cut()
    # second connection: ids jump, but it is a new start
    r.trades(SOL, 900, 900, 905)
    r.delta(ETH, ("sell", "1", "1"))
    r.cut()
    # third: nothing but one book, of both products ETH only
    r.book(ETH, 70, 3)
    r.trades(ETH, 700, 702, price="70")
    r.delta(ETH, ("sell", "71", "9"), ("buy", "68", "0"))
    r.beat(ETH, 700)
    return r.messages


SESSION = session()
#: What becomes of it, counted by hand from the comments above.
FOUND = {"sequence_gaps_total": 3, "messages_lost_total": 2 + 3 + 4 + 1, "duplicates_total": 2, "heartbeat_detected_gaps_total": 1, "book_resets_total": 2, "crossed_books_total": 1}
CHANNELS = {"trades": 12, "l2": 10, "heartbeat": 4}


def raw_trade(i, second, price="10", size="1", side="buy", product="BTC-USD", lag_ms=40, sequence=None, message_id=None, **more) -> dict:
    event, arrival = CLOCK + timedelta(seconds=second), CLOCK + timedelta(seconds=second, milliseconds=lag_ms)
    return {
        "sequence": i if sequence is None else sequence, "product_id": product, "trade_id": i, "price": price, "size": size, "side": side, "maker_order_id": "", "taker_order_id": "t",
        "event_time": event.strftime("%Y-%m-%dT%H:%M:%S.%fZ"), "ingest_time": arrival.strftime("%Y-%m-%dT%H:%M:%S.%fZ"), "subscription_name": "s", "message_id": message_id or f"m{i}", "publish_time": arrival, "attributes": "{}",
    } | more
