"""Camera solving from board corners, one camera per group: intrinsics, board poses, reprojection errors, and the pose of each camera against the reference.

Distortion is taken as zero, as everywhere in this library. A group holds a camera's sampled detections, a bounded number.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model import REFERENCE


def homography(board: np.ndarray, image: np.ndarray) -> np.ndarray:
    """The plane's map to the image from at least four points, by the direct linear transform on centred points."""

    def centred(p):
        mean, scale = p.mean(axis=0), np.sqrt(2) / (p - p.mean(axis=0)).std(axis=0).mean()
        return (p - mean) * scale, np.array([[scale, 0, -scale * mean[0]], [0, scale, -scale * mean[1]], [0, 0, 1]])

    a, t = centred(board)
    b, s = centred(image)
    one, zero = np.ones(len(a)), np.zeros((len(a), 3))
    h = np.column_stack([a, one])
    rows = np.vstack([np.hstack([h, zero, -b[:, :1] * h]), np.hstack([zero, h, -b[:, 1:] * h])])
    m = np.linalg.inv(s) @ np.linalg.svd(rows)[2][-1].reshape(3, 3) @ t
    return m / m[2, 2]


def rodrigues(v: np.ndarray) -> np.ndarray:
    """The rotation about v by its length."""
    angle = np.linalg.norm(v)
    if angle < 1e-12:
        return np.eye(3)
    x, y, z = v / angle
    k = np.array([[0, -z, y], [z, 0, -x], [-y, x, 0]])
    return np.eye(3) + np.sin(angle) * k + (1 - np.cos(angle)) * k @ k


def rotation_vector(r: np.ndarray) -> np.ndarray:
    angle = np.arccos(np.clip((np.trace(r) - 1) / 2, -1, 1))
    axis = np.array([r[2, 1] - r[1, 2], r[0, 2] - r[2, 0], r[1, 0] - r[0, 1]])
    return axis / 2 if angle < 1e-9 else axis * angle / (2 * np.sin(angle))


def project(board: np.ndarray, k: np.ndarray, pose: np.ndarray) -> np.ndarray:
    """Points of the board's plane in the image; a pose is a rotation vector and a shift."""
    p = np.column_stack([board, np.zeros(len(board))]) @ rodrigues(pose[:3]).T + pose[3:]
    return p[:, :2] / p[:, 2:] * np.diag(k)[:2] + k[:2, 2]


def descend(f, x: np.ndarray, rounds: int = 40) -> np.ndarray:
    """Levenberg-Marquardt on residuals f(x) with a numeric Jacobian."""
    damp, r = 1e-3, f(x)
    for _ in range(rounds):
        step = 1e-6 * np.maximum(1, np.abs(x))
        jac = np.column_stack([(f(x + step[i] * e) - r) / step[i] for i, e in enumerate(np.eye(len(x)))])
        move = np.linalg.solve(jac.T @ jac + damp * np.diag(np.maximum(1e-12, (jac**2).sum(axis=0))), -jac.T @ r)
        new = f(x + move)
        if new @ new < r @ r:
            done = r @ r - new @ new < 1e-12 * (1 + r @ r)
            x, r, damp = x + move, new, damp / 3
            if done:
                break
        else:
            damp *= 5
    return x


def first_pose(h: np.ndarray, k: np.ndarray) -> np.ndarray:
    """A board's pose from its homography, turned to the nearest rotation, in front of the camera."""
    m = np.linalg.inv(k) @ h
    m *= np.sign(m[2, 2]) / np.linalg.norm(m[:, :2], axis=0).mean()
    u, _, v = np.linalg.svd(np.column_stack([m[:, 0], m[:, 1], np.cross(m[:, 0], m[:, 1])]))
    return np.concatenate([rotation_vector(u @ np.diag([1, 1, np.linalg.det(u @ v)]) @ v), m[:, 2]])


def pose(board: np.ndarray, image: np.ndarray, k: np.ndarray) -> np.ndarray:
    return descend(lambda x: (project(board, k, x) - image).ravel(), first_pose(homography(board, image), k))


def intrinsics(boards: list[np.ndarray], images: list[np.ndarray], size: tuple[int, int]) -> np.ndarray:
    """K without skew: the principal point starts at the image's middle, the focal lengths follow from the homographies, and all are refined with the poses."""
    hs = [homography(b, i) for b, i in zip(boards, images)]
    cx, cy = (size[0] - 1) / 2, (size[1] - 1) / 2
    rows, right = [], []
    for h in hs:
        g = np.array([[1, 0, -cx], [0, 1, -cy], [0, 0, 1]]) @ h
        (a, b, c), (d, e, f) = g[:, 0], g[:, 1]
        rows += [[a * d, b * e], [a * a - d * d, b * b - e * e]]
        right += [-c * f, f * f - c * c]
    w = np.abs(np.linalg.lstsq(np.array(rows), np.array(right), rcond=None)[0])
    fx, fy = 1 / np.sqrt(np.maximum(w, 1e-12))
    matrix = lambda x: np.array([[x[0], 0, x[2]], [0, x[1], x[3]], [0, 0, 1]])
    start = np.concatenate([[fx, fy, cx, cy], *[first_pose(h, matrix([fx, fy, cx, cy])) for h in hs]])
    miss = lambda x: np.concatenate([(project(b, matrix(x), x[4 + 6 * i : 10 + 6 * i]) - p).ravel() for i, (b, p) in enumerate(zip(boards, images))])
    return matrix(descend(miss, start))


#: Detections: camera_id, frame_index, board (x, y flat), corners (x, y flat).
def _pairs(rows: pd.DataFrame) -> list[tuple[int, np.ndarray, np.ndarray]]:
    rows = rows.sort_values("frame_index")
    return [(int(f), np.reshape(b, (-1, 2)).astype(float), np.reshape(c, (-1, 2)).astype(float)) for f, b, c in zip(rows.frame_index, rows.board, rows.corners)]


def solve_cameras(detections: DataFrame, width: int, height: int, least: int = 5) -> DataFrame:
    """camera_id, fx, fy, cx, cy, n_frames, status; a camera with too few detections is reported, not dropped."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        own = _pairs(rows)
        k = intrinsics([b for _, b, _ in own], [c for _, _, c in own], (width, height)) if len(own) >= least else np.full((3, 3), np.nan)
        return pd.DataFrame([[rows.camera_id.iloc[0], *k[[0, 1], [0, 1]], k[0, 2], k[1, 2], len(own), "ok" if len(own) >= least else "too_few_detections"]], columns=["camera_id", "fx", "fy", "cx", "cy", "n_frames", "status"])

    return detections.groupBy("camera_id").applyInPandas(run, "camera_id string, fx double, fy double, cx double, cy double, n_frames long, status string")


def poses(detections: DataFrame, solved: DataFrame) -> DataFrame:
    """camera_id, frame_index, rotation vector and shift of the board, mean and max reprojection error; each frame on its own."""

    def run(batches):
        for df in batches:
            out = []
            for r in df.itertuples():
                k = np.array([[r.fx, 0, r.cx], [0, r.fy, r.cy], [0, 0, 1]])
                b, c = (np.reshape(v, (-1, 2)).astype(float) for v in (r.board, r.corners))
                x = pose(b, c, k)
                miss = np.linalg.norm(project(b, k, x) - c, axis=1)
                out.append((r.camera_id, r.frame_index, x[:3].tolist(), x[3:].tolist(), float(miss.mean()), float(miss.max())))
            yield pd.DataFrame(out, columns=["camera_id", "frame_index", "rvec", "tvec", "mean_error", "max_error"])

    joined = detections.join(F.broadcast(solved.where("status = 'ok'").select("camera_id", "fx", "fy", "cx", "cy")), "camera_id")
    return joined.mapInPandas(run, "camera_id string, frame_index int, rvec array<double>, tvec array<double>, mean_error double, max_error double")


def relative_poses(boards: DataFrame, least: int = 5) -> DataFrame:
    """Per other camera, the pose that takes its coordinates to the reference's, over shared frames: the mean rotation, the mean shift, and the number of frames; too few are reported."""
    ref = boards.where(F.col("camera_id") == REFERENCE).select("frame_index", F.col("rvec").alias("ref_r"), F.col("tvec").alias("ref_t"))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rs, ts = [], []
        for r in rows.itertuples():
            own, master = rodrigues(np.array(r.rvec)), rodrigues(np.array(r.ref_r))
            rs.append(master @ own.T)
            ts.append(np.array(r.ref_t) - rs[-1] @ np.array(r.tvec))
        u, _, v = np.linalg.svd(np.mean(rs, axis=0))
        mean = u @ np.diag([1, 1, np.linalg.det(u @ v)]) @ v
        ok = len(rs) >= least
        return pd.DataFrame([[rows.camera_id.iloc[0], mean.ravel().tolist() if ok else None, np.mean(ts, axis=0).tolist() if ok else None, len(rs), "ok" if ok else "too_few_common_frames"]], columns=["camera_id", "R_rel", "T_rel", "n_common", "status"])

    return boards.where(F.col("camera_id") != REFERENCE).join(ref, "frame_index").groupBy("camera_id").applyInPandas(run, "camera_id string, R_rel array<double>, T_rel array<double>, n_common long, status string")


def _jacobian(f, x: np.ndarray) -> np.ndarray:
    r, step = f(x), 1e-6 * np.maximum(1, np.abs(x))
    return np.column_stack([(f(x + step[i] * e) - r) / step[i] for i, e in enumerate(np.eye(len(x)))])


def joint_pose(pairs: list[tuple], k: np.ndarray, k_ref: np.ndarray, x: np.ndarray, rounds: int = 12) -> tuple[np.ndarray, float]:
    """The pose (rotation vector, shift) from a camera's coordinates to the reference's that fits all shared boards, with a pose for each board, and the root mean square error over the points of both cameras. pairs: board, own corners, reference corners, first board pose in the camera. Each board's pose is eliminated from the normal equations, so a round solves 6 x 6 systems only."""

    def miss(x, b, pair):
        board, own, ref = pair[:3]
        turn = rodrigues(x[:3])
        r = turn @ rodrigues(b[:3])
        seen = np.concatenate([rotation_vector(r), turn @ b[3:] + x[3:]])
        return np.concatenate([(project(board, k, b) - own).ravel(), (project(board, k_ref, seen) - ref).ravel()])

    boards, damp = [np.asarray(p[3], dtype=float) for p in pairs], 1e-4
    cost = lambda x, bs: sum(float((miss(x, b, p) ** 2).sum()) for b, p in zip(bs, pairs))
    now = cost(x, boards)
    for _ in range(rounds):
        total, right, parts = np.zeros((6, 6)), np.zeros(6), []
        for b, p in zip(boards, pairs):
            r, a, c = miss(x, b, p), _jacobian(lambda v: miss(v, b, p), x), _jacobian(lambda v: miss(x, v, p), b)
            inner = np.linalg.inv(c.T @ c + damp * np.diag(np.maximum(1e-12, (c**2).sum(axis=0))))
            cross = a.T @ c @ inner
            total += a.T @ a - cross @ c.T @ a
            right += -a.T @ r + cross @ c.T @ r
            parts.append((inner, c, a, r))
        move = np.linalg.solve(total + damp * np.diag(np.maximum(1e-12, np.diag(total))), right)
        tried = [b + i @ (-c.T @ r - c.T @ a @ move) for b, (i, c, a, r) in zip(boards, parts)]
        new = cost(x + move, tried)
        if new < now:
            done = now - new < 1e-10 * (1 + now)
            x, boards, now, damp = x + move, tried, new, damp / 3
            if done:
                break
        else:
            damp *= 10
    return x, float(np.sqrt(now / sum(len(p[1]) + len(p[2]) for p in pairs)))


def stereo(detections: DataFrame, boards: DataFrame, solved: DataFrame, least: int = 5) -> DataFrame:
    """camera_id, R_rel, T_rel, error (pixels), n_common, status of each other camera: relative_poses() refined jointly over all boards that both cameras see, intrinsics fixed. A group holds a camera's shared detections, a bounded number."""
    seen = detections.where(F.size("corners") > 0).select("camera_id", "frame_index", "board", "corners")
    own = seen.join(boards.select("camera_id", "frame_index", "rvec", "tvec"), ["camera_id", "frame_index"])
    ref = own.where(F.col("camera_id") == REFERENCE).select("frame_index", F.col("corners").alias("ref_corners"), F.col("rvec").alias("ref_r"), F.col("tvec").alias("ref_t"))
    matrix = F.array("fx", "fy", "cx", "cy")
    ks = solved.where("status = 'ok'").select("camera_id", matrix.alias("k"))
    ref_k = ks.where(F.col("camera_id") == REFERENCE).select(F.col("k").alias("ref_k"))
    rows = own.where(F.col("camera_id") != REFERENCE).join(ref, "frame_index").join(F.broadcast(ks), "camera_id").join(F.broadcast(ref_k), F.lit(True))
    full = lambda v: np.array([[v[0], 0, v[2]], [0, v[1], v[3]], [0, 0, 1]])

    def run(df: pd.DataFrame) -> pd.DataFrame:
        name, n = df.camera_id.iloc[0], len(df)
        if n < least:
            return pd.DataFrame([[name, None, None, None, n, "too_few_common_frames"]], columns=columns)
        df = df.sort_values("frame_index")
        flat = lambda v: np.reshape(np.asarray(v, dtype=float), (-1, 2))
        pairs, rs, ts = [], [], []
        for r in df.itertuples():
            pairs.append((flat(r.board), flat(r.corners), flat(r.ref_corners), np.concatenate([r.rvec, r.tvec])))
            rs.append(rodrigues(np.array(r.ref_r)) @ rodrigues(np.array(r.rvec)).T)
            ts.append(np.array(r.ref_t) - rs[-1] @ np.array(r.tvec))
        u, _, v = np.linalg.svd(np.mean(rs, axis=0))
        first = np.concatenate([rotation_vector(u @ np.diag([1, 1, np.linalg.det(u @ v)]) @ v), np.mean(ts, axis=0)])
        x, error = joint_pose(pairs, full(df.k.iloc[0]), full(df.ref_k.iloc[0]), first)
        return pd.DataFrame([[name, rodrigues(x[:3]).ravel().tolist(), x[3:].tolist(), error, n, "ok"]], columns=columns)

    columns = ["camera_id", "R_rel", "T_rel", "error", "n_common", "status"]
    return rows.groupBy("camera_id").applyInPandas(run, "camera_id string, R_rel array<double>, T_rel array<double>, error double, n_common long, status string")


def rectified_residuals(detections: DataFrame, calibration: DataFrame) -> DataFrame:
    """(mode, camera_id, residual): the vertical distance of each corner to the reference's after rectification by R_rel and by its inverse; both go to the reference's matrix."""
    k = F.struct(F.col("K")[0][0].alias("fx"), F.col("K")[1][1].alias("fy"), F.col("K")[0][2].alias("cx"), F.col("K")[1][2].alias("cy")).alias("k")
    cams = calibration.select("camera_id", k, F.flatten("R_rel").alias("r"))
    master = cams.where(F.col("camera_id") == REFERENCE).select(F.col("k").alias("p"))
    points = detections.select("camera_id", "frame_index", F.posexplode(F.expr("transform(sequence(0, size(corners) div 2 - 1), i -> struct(corners[2 * i] as u, corners[2 * i + 1] as v))")).alias("corner", "c")).where("c.u is not null")
    rows = points.join(F.broadcast(cams), "camera_id").join(F.broadcast(master), F.lit(True))
    x, y = (F.col("c.u") - F.col("k.cx")) / F.col("k.fx"), (F.col("c.v") - F.col("k.cy")) / F.col("k.fy")

    def height(turned: bool):
        at = lambda i, j: F.col("r")[3 * j + i if turned else 3 * i + j]
        b, c = (at(i, 0) * x + at(i, 1) * y + at(i, 2) for i in (1, 2))
        return F.col("p.fy") * (b / c) + F.col("p.cy")

    modes = F.explode(F.array(F.struct(F.lit("direct").alias("mode"), height(False).alias("v")), F.struct(F.lit("inverse").alias("mode"), height(True).alias("v")))).alias("m")
    rows = rows.select("camera_id", "frame_index", "corner", modes).select("camera_id", "frame_index", "corner", "m.mode", "m.v")
    ref = rows.where(F.col("camera_id") == REFERENCE).select("frame_index", "corner", "mode", F.col("v").alias("ref_v"))
    return rows.where(F.col("camera_id") != REFERENCE).join(ref, ["frame_index", "corner", "mode"]).select("mode", "camera_id", F.abs(F.col("v") - F.col("ref_v")).alias("residual"))
