"""Words that need not wait stay out of state."""

import pandas as pd

from plumbline.streaming import jobs as J


class _Handle:
    """State of one key that counts what is asked of it."""

    def __init__(self):
        self.calls, self.map, self.value = 0, {}, None

    def getMapState(self, *_):
        return self

    def getValueState(self, *_):
        return _Value(self)

    def containsKey(self, k):
        self.calls += 1
        return k in self.map

    def getValue(self, k):
        self.calls += 1
        return self.map[k]

    def updateValue(self, k, v):
        self.calls += 1
        self.map[k] = v

    def removeKey(self, k):
        self.calls += 1
        self.map.pop(k, None)

    def clear(self):
        self.calls += 1
        self.map.clear()


class _Value:
    def __init__(self, handle):
        self.handle = handle

    def exists(self):
        self.handle.calls += 1
        return self.handle.value is not None

    def get(self):
        self.handle.calls += 1
        return self.handle.value

    def update(self, v):
        self.handle.calls += 1
        self.handle.value = v

    def clear(self):
        self.handle.calls += 1
        self.handle.value = None


def _run(batches):
    cues, handle, out = J.cue_processor(3, 1.5), _Handle(), []
    cues.init(handle)
    for b in batches:
        rows = pd.DataFrame([(1, i, f"w{i}", i * 0.5, i * 0.5 + 0.4, i == 9) for i in b], columns=["doc", "idx", "word", "start_s", "end_s", "last"])
        for made in cues.handleInputRows((1,), iter([rows]), None):
            out += made.values.tolist()
    return out, handle


def test_words_of_a_whole_document_ask_state_once():
    whole, handle = _run([range(10)])
    assert handle.calls == 1 and [r[1] for r in whole] == [0, 3, 6, 9]
    for batches in ([[9, 4], [0, 1, 2], [8, 3], [5, 7], [6]], [[0, 1], [2, 3], [4, 5], [6, 7], [8, 9]], [[i] for i in range(9, -1, -1)]):
        parts, handle = _run(batches)
        assert parts == whole and not handle.map and handle.value is None
