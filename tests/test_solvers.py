"""Synthetic boards: known cameras come back."""

import numpy as np

from lumengrid.operators import solvers


def test_solvers(spark):
    rng = np.random.default_rng(7)
    board = np.array([[x * 25.0, y * 25.0] for y in range(8) for x in range(8)])
    cams = {"CAM_C3": (np.array([[1500.0, 0, 965], [0, 1490.0, 535], [0, 0, 1]]), np.zeros(6)), "CAM_A1": (np.array([[1450.0, 0, 950], [0, 1455.0, 545], [0, 0, 1]]), np.array([0.02, -0.1, 0.03, 120.0, -60.0, 10.0])), "CAM_B2": (np.eye(3) * 1000, np.zeros(6))}
    rows = []
    for f in range(8):
        pose = np.concatenate([rng.uniform(-0.5, 0.5, 3), [rng.uniform(-150, 50), rng.uniform(-120, 20), rng.uniform(700, 1000)]])
        for name, (k, rel) in cams.items():
            if name == "CAM_B2" and f > 1:
                continue
            # rel takes the camera's coordinates to the reference's, so the board's pose is its inverse after the reference's
            r, t = solvers.rodrigues(rel[:3]), rel[3:]
            own = np.concatenate([solvers.rotation_vector(r.T @ solvers.rodrigues(pose[:3])), r.T @ (pose[3:] - t)])
            seen = solvers.project(board, k, own) + rng.normal(0, 0.02, board.shape)
            rows.append((name, f, board.ravel().tolist(), seen.ravel().tolist()))
    df = spark.createDataFrame(rows, "camera_id string, frame_index int, board array<double>, corners array<double>")
    solved = solvers.solve_cameras(df, 1920, 1080).cache()
    got = {r.camera_id: r for r in solved.collect()}
    assert got["CAM_B2"].status == "too_few_detections" and got["CAM_B2"].n_frames == 2
    for name in ("CAM_C3", "CAM_A1"):
        k = cams[name][0]
        assert abs(got[name].fx - k[0, 0]) < 5 and abs(got[name].fy - k[1, 1]) < 5 and abs(got[name].cx - k[0, 2]) < 5 and abs(got[name].cy - k[1, 2]) < 5
    boards = solvers.poses(df, solved)
    assert all(r.mean_error < 0.1 for r in boards.collect())
    rel = solvers.relative_poses(boards).collect()
    assert [r.camera_id for r in rel] == ["CAM_A1"]
    want = cams["CAM_A1"][1]
    assert np.abs(np.reshape(rel[0].R_rel, (3, 3)) - solvers.rodrigues(want[:3])).max() < 0.01 and np.abs(np.array(rel[0].T_rel) - want[3:]).max() < 6
