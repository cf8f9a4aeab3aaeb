import sys
import uuid
from datetime import datetime
from decimal import Decimal
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemark.schemas import STAGED_EVENT  # noqa: E402
from tidemark.session import local_session  # noqa: E402
from tidemark.sources.scratch import new_folder, release  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests")
    session.sparkContext.setLogLevel("OFF")
    yield session
    release(session)
    session.stop()


@pytest.fixture
def folder(spark):
    return lambda label="test": new_folder(spark, label)


@pytest.fixture
def staged(spark):
    """Build staged events from short tuples: user, type, time and optional fields."""

    def build(rows):
        out = []
        for user, kind, at, *rest in rows:
            extra = rest[0] if rest else {}
            at = datetime.fromisoformat(at) if at else None
            out.append(
                (
                    extra.get("event_id", uuid.uuid4().hex),
                    user,
                    kind,
                    at,
                    extra.get("event_date", at.date() if at else None),
                    extra.get("platform", "web"),
                    extra.get("country", "US"),
                    extra.get("product_id"),
                    Decimal(str(extra["amount"])) if "amount" in extra else None,
                    extra.get("session_id", "SES_1"),
                    extra.get("metadata", "{}"),
                )
            )
        return spark.createDataFrame(out, STAGED_EVENT)

    return build
